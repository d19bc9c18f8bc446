"""Queries on whole page plans. Input rows the driver's tables lack are made up the same on both sides."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.functions import text as X
from broadsheet.operators import articles as A
from broadsheet.operators import glossary, layout, pages
from broadsheet.plans.layout_queries import BLOCKS, blocks
from broadsheet.plans.registry import Registry, table
from broadsheet.plans.text_queries import ARTICLES, WORDS, articles

register = Registry()


def _made(spark: SparkSession, sf_dir: str, rows: list[tuple], kind: str) -> DataFrame:
    """The same blocks on one page for each customer."""
    made = spark.createDataFrame(rows, kind)
    keys = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("page"))
    return keys.select("page", F.explode(F.array(*[F.struct(*[F.lit(v).cast(t).alias(c) for v, c, t in zip(r, made.columns, (f.dataType for f in made.schema), strict=True)]) for r in rows])).alias("b")).select("page", "b.*")


BOX = "ordinal int, id string, x0 double, y0 double, x1 double, y1 double, text string, max_font_size double, median_font_size double, width double, height double"
_BODY = "word " * 60
MAGAZINE = [
    (1, "b1", 40.0, 40.0, 200.0, 60.0, "COVER STORY", 20.0, 16.0, 600.0, 800.0),
    (2, "b2", 40.0, 100.0, 500.0, 160.0, "Why Big Oil Still Pays,Now", 44.0, 30.0, 600.0, 800.0),
    (3, "b3", 300.0, 200.0, 500.0, 700.0, "then it went on " + _BODY, 9.0, 9.0, 600.0, 800.0),
    (4, "b4", 50.0, 200.0, 250.0, 700.0, "he price of oil " + _BODY, 9.0, 9.0, 600.0, 800.0),
    (5, "b5", 40.0, 190.0, 60.0, 230.0, "T", 48.0, 48.0, 600.0, 800.0),
    (6, "b6", 40.0, 710.0, 500.0, 760.0, "Listen: in a weekly podcast by Barron's. Subscribe to Barron's on your favorite listening app. " + _BODY, 9.0, 9.0, 600.0, 800.0),
]


@register(f"""SELECT n_nationkey AS page, 'Why Big Oil Still Pays, Now' AS title, 'COVER STORY' AS category, 'The price of oil {_BODY.strip()}' || chr(10) || chr(10) || 'then it went on {_BODY.strip()}' AS body, 'b4,b3' AS block_ids FROM nation""")
def magazine_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.magazine_articles(_made(spark, sf_dir, MAGAZINE, BOX))
    return found.withColumn("block_ids", F.array_join("block_ids", ","))


CONTINUED = [(1, "c1", 50.0, 100.0, 250.0, 700.0, "more " * 200, 9.0, 9.0, 600.0, 800.0), (2, "c2", 300.0, 100.0, 500.0, 700.0, "rest " * 120, 9.0, 9.0, 600.0, 800.0)]


@register(f"""SELECT 'i' AS issue, n_nationkey AS page, 'First' AS title, '{("more " * 200).strip()}' || chr(10) || chr(10) || '{("rest " * 120).strip()}' AS body, true AS is_continuation FROM nation""")
def magazine_continuation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _made(spark, sf_dir, CONTINUED, BOX)
    before = spark.createDataFrame([("i", -2, "Zero"), ("i", -1, "First")], "issue string, page int, title string").withColumn("page", F.col("page").cast(rows.schema["page"].dataType))
    return pages.continuation_pages(rows, before, rows.select("page", F.lit("i").alias("issue")).distinct())


WORLD = [
    (1, "w1", 30.0, 80.0, 200.0, 100.0, "Politics", 20.0, 20.0, 600.0, 800.0),
    (2, "w2", 470.0, 120.0, 580.0, 300.0, "Fourth\ncolumn", 9.0, 9.0, 600.0, 800.0),
    (3, "w3", 20.0, 400.0, 140.0, 500.0, "Second", 9.0, 9.0, 600.0, 800.0),
    (4, "w4", 25.0, 120.0, 140.0, 300.0, "First", 9.0, 9.0, 600.0, 800.0),
    (5, "w5", 20.0, 20.0, 300.0, 40.0, "margin", 9.0, 9.0, 600.0, 800.0),
    (6, "w6", 20.0, 90.0, 300.0, 110.0, "7 The Economist May 3rd 2026", 9.0, 9.0, 600.0, 800.0),
    (7, "w7", 20.0, 600.0, 300.0, 640.0, "fine print", 4.0, 4.0, 600.0, 800.0),
]


@register("""SELECT n_nationkey AS page, 'Politics' AS title, 'THE WORLD THIS WEEK' AS category, 'First' || chr(10) || chr(10) || 'Second' || chr(10) || chr(10) || 'Fourth column' AS body, true AS bypass FROM nation""")
def world_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _made(spark, sf_dir, WORLD, BOX)
    return pages.world_pages(rows, rows.select("page", F.lit("world_this_week_politics").alias("kind")).distinct())


FRONT = [
    (1, "f1", 30.0, 100.0, 130.0, 120.0, "What’s News", 14.0, 14.0, 634.0, 1219.0),
    (2, "f2", 32.0, 140.0, 140.0, 300.0, "• One thing A2", 8.0, 8.0, 634.0, 1219.0),
    (3, "f3", 30.0, 60.0, 160.0, 700.0, "Worldwide\n• Else B1", 8.0, 8.0, 634.0, 1219.0),
    (4, "f4", 170.0, 100.0, 400.0, 900.0, "Main story", 8.0, 8.0, 634.0, 1219.0),
    (5, "f5", 31.0, 900.0, 140.0, 950.0, "CONTENTS\nBooks C1", 8.0, 8.0, 634.0, 1219.0),
    (6, "f6", 31.0, 960.0, 140.0, 990.0, "after", 8.0, 8.0, 634.0, 1219.0),
    (7, "f7", 520.0, 200.0, 620.0, 220.0, "Briefing", 14.0, 14.0, 634.0, 1219.0),
    (8, "f8", 522.0, 230.0, 620.0, 400.0, "» A note; PAGE 3\n» Other", 8.0, 8.0, 634.0, 1219.0),
    (9, "f9", 522.0, 410.0, 620.0, 450.0, "World Markets today", 8.0, 8.0, 634.0, 1219.0),
]


@register("""SELECT n_nationkey AS page, kind, id, place FROM nation, (VALUES ('directory', 'f1', 1), ('directory', 'f3', 2), ('directory', 'f2', 3), ('briefing', 'f7', 1), ('briefing', 'f8', 2)) t(kind, id, place)""")
def directory_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _made(spark, sf_dir, FRONT, BOX)
    both = layout.directory_region(rows).withColumn("kind", F.lit("directory")).unionByName(layout.briefing_region(rows).withColumn("kind", F.lit("briefing")))
    return both.select("page", "kind", "id", F.col("place").cast("int").alias("place"))


BRIEFING = ["Noise", "Briefing", "» Rates held", "again; PAGE 12", "- > Second item", "", "World markets and more", "» Not this"]


@register("""SELECT n_nationkey AS page, item_no, text, label FROM nation, (VALUES (1, 'Rates held again; PAGE 12', '12'), (2, 'Second item', NULL)) t(item_no, text, label)""")
def briefing_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("page"))
    found = layout.parse_briefing(keys.select("page", F.posexplode(F.array(*map(F.lit, BRIEFING))).alias("line_no", "line")))
    return found.select("page", F.col("item_no").cast("int").alias("item_no"), "text", "label")


@register(rf"""WITH {BLOCKS}, f AS (SELECT *, x0 + 90 AS x1, y0 + 25 AS y1, CASE WHEN ordinal % 4 = 1 THEN 30.0 ELSE 8.0 END AS font, {WORDS.format("text")} AS n FROM b),
h AS (SELECT page, id AS heading, ordinal AS ho, text AS title, x0 AS hx0, x1 AS hx1, y1 AS hy1 FROM f WHERE font >= 11.6 AND y0 >= 110 AND y0 <= height - 45 AND n BETWEEN 3 AND 24 AND length(regexp_replace(text, '^[ \t-\r]+|[ \t-\r]+$', '', 'g')) <= 190),
o AS (SELECT f.* FROM f LEFT JOIN h ON f.page = h.page AND f.id = h.heading WHERE h.heading IS NULL),
p AS (SELECT o.page, o.id, o.ordinal, o.text, o.x0, o.y0, heading, ho, title, round(y0 - hy1 + 0.18 * abs((x0 + x1) / 2 - (hx0 + hx1) / 2) - 60 * greatest(0, least(x1, hx1) - greatest(x0, hx0)) / greatest(least(x1 - x0, hx1 - hx0), 1), 4) AS score FROM o JOIN h ON o.page = h.page
  WHERE y0 - hy1 >= -2 AND y0 - hy1 <= 900 AND greatest(0, least(x1, hx1) - greatest(x0, hx0)) / greatest(least(x1 - x0, hx1 - hx0), 1) >= 0.12),
r AS (SELECT *, row_number() OVER (PARTITION BY page, id ORDER BY score, ho) AS r FROM p),
g AS (SELECT page, ho AS ordinal, any_value(title) AS title, string_agg(id, ',' ORDER BY round_even(x0 / 20, 0), y0, ordinal) AS block_ids, sum({WORDS.format("text")}) AS n FROM r WHERE r = 1 GROUP BY page, ho)
SELECT page, ordinal, regexp_replace(title, '^[ \t-\r]+|[ \t-\r]+$', '', 'g') AS title, block_ids FROM g WHERE n >= 50""")
def local_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    font = F.when(F.col("ordinal") % 4 == 1, 30.0).otherwise(8.0)
    rows = blocks(spark, sf_dir).withColumns({"max_font_size": font, "median_font_size": F.lit(8.0)})
    return pages.local_articles(rows).select("page", "ordinal", "title", F.array_join("block_ids", ",").alias("block_ids"))


@register(rf"""WITH {BLOCKS}, q AS (SELECT page, 'b3' AS id, 1 AS pos FROM b GROUP BY page UNION ALL SELECT page, 'b1', 2 FROM b GROUP BY page UNION ALL SELECT page, 'b99999', 3 FROM b GROUP BY page)
SELECT q.page, 1 AS article, string_agg(b.id, ',' ORDER BY pos) AS block_ids, string_agg(regexp_replace(text, '^[ \t-\r]+|[ \t-\r]+$', '', 'g'), chr(10) || chr(10) ORDER BY pos) AS body FROM q JOIN b ON q.page = b.page AND q.id = b.id GROUP BY q.page""")
def block_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = blocks(spark, sf_dir)
    wanted = rows.select("page").distinct().select("page", F.lit(1).alias("article"), F.array(*map(F.lit, ("b3", "b1", "b99999", "b3"))).alias("block_ids"))
    return pages.assemble(wanted, rows).withColumn("block_ids", F.array_join("block_ids", ","))


@register(rf"""WITH {ARTICLES}, g AS (SELECT page, 1 AS no, ordinal FROM a WHERE ordinal % 5 < 2 UNION ALL SELECT page, 2, ordinal FROM a WHERE ordinal % 5 BETWEEN 1 AND 2 UNION ALL SELECT page, 3, ordinal FROM a WHERE ordinal % 100 = 4),
f AS (SELECT page, ordinal, min(no) AS no FROM g GROUP BY ALL), w AS (SELECT *, count(*) OVER (PARTITION BY page, no) AS n, min(ordinal) OVER (PARTITION BY page, no) AS into_ FROM f) SELECT page, ordinal, into_ AS target FROM w WHERE n >= 2""")
def proposed_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = articles(spark, sf_dir).select("page", "ordinal")
    k = F.col("ordinal")
    member = lambda no, c: rows.filter(c).groupBy("page").agg(F.collect_list("ordinal").alias("members")).withColumn("group_no", F.lit(no))
    groups = member(1, k % 5 < 2).unionByName(member(2, (k % 5).between(1, 2))).unionByName(member(3, k % 100 == 4))
    return pages.merge_groups(rows, groups).withColumnRenamed("into", "target")


@register(rf"""WITH {ARTICLES} SELECT issue, page, row_number() OVER (PARTITION BY issue, page ORDER BY ordinal) AS number, title, category, CAST({WORDS.format("body")} AS BIGINT) AS word_count, left(regexp_replace(body, '[ \t-\r]+', ' ', 'g'), 180) AS start, right(regexp_replace(body, '[ \t-\r]+', ' ', 'g'), 180) AS "end" FROM a""")
def article_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.profile(articles(spark, sf_dir))


HEADLINES = [("GoodNews,bad",), ("Why AIStocks rose",), ("The 5best ideas",), ("Paid$5 for oil- rich land",), ("Tech!Now\nA",), ("TheCEO speaks",)]


@register("""SELECT * FROM (VALUES ('GoodNews,bad', 'GoodNews, bad'), ('Why AIStocks rose', 'Why AI Stocks rose'), ('The 5best ideas', 'The 5 best ideas'), ('Paid$5 for oil- rich land', 'Paid $5 for oil-rich land'), ('Tech!Now' || chr(10) || 'A', 'Tech! Now'), ('TheCEO speaks', 'The CEO speaks')) t(raw, headline)""")
def headline_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame(HEADLINES, "raw string").select("raw", pages.headline_text(F.col("raw")).alias("headline"))


@register("""WITH p AS (SELECT conv_id AS article, turn AS paragraph, '[' || turn || '] ' || text AS line, text FROM conversations WHERE text IS NOT NULL),
s AS (SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY article ORDER BY paragraph ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM p)
SELECT article, string_agg(CASE WHEN length(line) <= 900 - before THEN line ELSE regexp_replace(left(line, CAST(900 - before AS INT)), ' [^ ]*$', '') END, chr(10) ORDER BY paragraph) AS text FROM s WHERE before < 900 GROUP BY article""")
def prompt_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").filter("text is not null").select(F.col("conv_id").alias("article"), F.col("turn").alias("paragraph"), "text")
    return glossary.prompt_text(rows, 900)


@register(r"""WITH t AS (SELECT conv_id, turn, regexp_extract_all(text, '\b(?i)(the)\b', 1) AS hits FROM conversations)
SELECT conv_id AS article, turn AS paragraph, 'g' AS glossary_id, hits[i] AS surface, i AS occurrence FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM t)""")
def term_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("article"), F.col("turn").alias("paragraph"), "text")
    terms = rows.select("article", F.lit("g").alias("glossary_id"), F.lit("the").alias("term")).distinct()
    return glossary.locate(rows, terms)


@register("""SELECT l_orderkey AS article, l_linenumber AS seq FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, flag ORDER BY l_linenumber) AS r FROM (SELECT l_orderkey, l_linenumber, min(l_returnflag) AS flag FROM lineitem GROUP BY ALL)) WHERE r <= 2""")
def annotation_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("article"), F.col("l_linenumber").alias("seq")).agg(F.min("l_returnflag").alias("glossary_id"))
    rows = rows.withColumns({"paragraph": F.col("seq"), "surface": F.lit("s"), "occurrence": F.lit(1)})
    return glossary.distinct_places(rows).select("article", "seq")


@register("""SELECT n_nationkey AS page, 'b' AS kind FROM nation WHERE false UNION ALL SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN 'utility' ELSE 'normal' END FROM nation""")
def native_page_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _made(spark, sf_dir, [(1, "h1", 30.0, 120.0, 200.0, 140.0, "Index", 9.0, 9.0, 600.0, 800.0), (2, "h2", 30.0, 400.0, 200.0, 440.0, "Contents", 20.0, 20.0, 600.0, 800.0)], BOX)
    kinds = rows.select("page").distinct().withColumn("publication", F.when(F.col("page") % 2 == 0, "BARRONS").otherwise("FT"))
    return pages.native_heading(rows, kinds).select("page", "kind")


@register(r"""WITH l AS (SELECT page_id, list_filter(list_transform(string_split(coalesce(html, ''), chr(10)), lambda x: regexp_replace(x, '^[ \t-\r]+|[ \t-\r]+$', '', 'g')), lambda x: x <> '') AS ls FROM pages)
SELECT page_id, coalesce(left(list_filter(ls, lambda x: length(x) >= 8)[1], 120), 'Page ' || page_id || ' OCR Text') AS title FROM l""")
def page_fallbacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", A.page_fallback(F.coalesce("html", F.lit("")), F.col("page_id").cast("int"))["title"].alias("title"))


@register(r"""WITH p AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(coalesce(text, ''), '\n[ \t-\r]*\n'), lambda x: regexp_replace(x, '^[ \t-\r]+|[ \t-\r]+$', '', 'g')), lambda x: x <> '') AS ps FROM documents)
SELECT doc_id, CAST(len(ps) AS BIGINT) AS n, ps[1] AS first FROM p""")
def blank_line_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = X.paragraphs(F.coalesce("text", F.lit("")))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(found).cast("long").alias("n"), F.get(found, F.lit(0)).alias("first"))
