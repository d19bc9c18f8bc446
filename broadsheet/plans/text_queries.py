"""Queries on words, titles and texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.functions import dates, geometry
from broadsheet.functions import text as X
from broadsheet.operators import articles as A
from broadsheet.operators import fuzzy, layout, linking
from broadsheet.plans.registry import Registry, table
from broadsheet.sources import exports, files

register = Registry()

#: Documents as articles: the first line is the title, the rest the body.
ARTICLES = r"""a AS (SELECT doc_id AS ordinal, source AS issue, doc_id // 100 AS page, lang AS category,
  regexp_replace(split_part(coalesce(text, ''), chr(10), 1), '^[ \t-\r]+|[ \t-\r]+$', '', 'g') AS title,
  regexp_replace(substr(coalesce(text, ''), strpos(coalesce(text, '') || chr(10), chr(10)) + 1), '^[ \t-\r]+|[ \t-\r]+$', '', 'g') AS body FROM documents)"""
KEY = "trim(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g'))"
WORDS = r"len(regexp_extract_all({0}, '[A-Za-z0-9]+(?:[\x27-][A-Za-z0-9]+)?'))"

#: In these texts licence lines stand where periodicals have advertisements and service pages.
ADS = ("all rights reserved", "released under the mit license")
SERVICES = ("licensed under cc by", "apache license")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.from_documents(table(spark, sf_dir, "documents"))


def _reason() -> object:
    return A.reject_reason(F.col("title"), F.col("category"), F.col("body"), ads=ADS, services=SERVICES)


def _has(column: str, phrases: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({column}, '{p}')" for p in phrases) + ")"


REASON = rf"""{ARTICLES},
k AS (SELECT *, {KEY.format("title")} AS tk, {KEY.format("title || ' ' || left(body, 1200)")} AS ak,
  {KEY.format("title || ' ' || category || ' ' || left(body, 500)")} AS sk, {WORDS.format("body")} AS n,
  list_distinct(list_filter(string_split({KEY.format("title")}, ' '), lambda x: x <> '')) AS tw,
  list_distinct(string_split({KEY.format("body")}, ' ')) AS bw FROM a),
r AS (SELECT *, CASE
  WHEN tk IN ('market data', 'financial times share service', 'managed funds service', 'what s news', 'whats news') THEN 'blocked title'
  WHEN {KEY.format("category")} IN ('advertisement', 'advertising', 'sponsored content', 'paid post', 'brand content') OR {_has("ak", ADS)} THEN 'advertisement'
  WHEN body = '' THEN 'empty'
  WHEN n < 80 THEN 'short'
  WHEN regexp_matches(body, '(?i)\b(?:page|pages|p)[ \t-\r]*[0-9]+\b') AND len(tw) > 0 AND len(list_intersect(tw, bw)) >= greatest(2, len(tw) // 2) AND n < 160 THEN 'teaser'
  WHEN {_has("sk", SERVICES)} THEN 'service' END AS reason FROM k)"""


@register(f"WITH {REASON} SELECT issue AS source, coalesce(reason, 'kept') AS reason, count(*) AS n FROM r GROUP BY ALL")
def article_quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = articles(spark, sf_dir).select(F.col("issue").alias("source"), F.coalesce(_reason(), F.lit("kept")).alias("reason"))
    return rows.groupBy("source", "reason").agg(F.count(F.lit(1)).alias("n"))


@register(f"WITH {REASON} SELECT ordinal AS doc_id, title, CAST(n AS BIGINT) AS n_words FROM r WHERE reason IS NULL")
def article_clean_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = A.clean(articles(spark, sf_dir), ads=ADS, services=SERVICES)
    return kept.select(F.col("ordinal").alias("doc_id"), "title", X.word_count(F.col("body")).alias("n_words"))


@register(f"WITH {REASON} SELECT issue AS source, coalesce(category, 'all') AS lang, count(*) AS n, count(reason) AS n_rejected FROM r GROUP BY ROLLUP (issue, category) HAVING issue IS NOT NULL")
def rejects_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = articles(spark, sf_dir).withColumn("reason", _reason())
    found = rows.rollup("issue", "category").agg(F.count(F.lit(1)).alias("n"), F.count("reason").alias("n_rejected"))
    return found.filter("issue is not null").select(F.col("issue").alias("source"), F.coalesce("category", F.lit("all")).alias("lang"), "n", "n_rejected")


#: Rows that reach each reason, the same on both sides.
CASES = [
    (1, "Market Data", "", "some text"),
    (2, "Offer", "Paid Post", "text"),
    (3, "Deal", "News", "A promotional offer for you"),
    (4, "Nothing", "News", " "),
    (5, "Short one", "News", "too few words"),
    (6, "Oil prices rise again", "News", "Oil prices rise again today, see page 5. " + "word " * 90),
    (7, "Tables", "Money", "The Managed Funds Service lists " + "fund " * 90),
    (8, "Good", "News", "Plain prose of the day " + "word " * 90),
    (9, "Oil", "News", "Page 7 has more " + "word " * 200),
]
_VALUES = ", ".join(f"({i}, '{t}', '{c}', '{b}')" for i, t, c, b in CASES)


@register("SELECT * FROM (VALUES (1, 'blocked title'), (2, 'advertisement'), (3, 'advertisement'), (4, 'empty'), (5, 'short'), (6, 'teaser'), (7, 'service'), (8, 'kept'), (9, 'kept')) t(id, reason)")
def reject_reason_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.createDataFrame(CASES, "id int, title string, category string, body string")
    return rows.select("id", F.coalesce(A.reject_reason(F.col("title"), F.col("category"), F.col("body")), F.lit("kept")).alias("reason"))


@register(r"""WITH s AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
q AS (SELECT doc_id, length(t) AS chars, len(list_filter(regexp_split_to_array(t, '[ \t-\r]+'), lambda x: x <> '')) AS words,
  round(length(regexp_replace(t, '[^\p{L}\p{N}]', '', 'g')) / greatest(length(t), 1), 4) AS alnum_ratio,
  round(length(regexp_replace(t, '[^�]', '', 'g')) / greatest(length(t), 1), 4) AS replacement_ratio FROM s)
SELECT doc_id, chars, CAST(words AS BIGINT) AS words, alnum_ratio, replacement_ratio, chars >= 200 AND words >= 40 AND alnum_ratio >= 0.55 AND replacement_ratio <= 0.02 AS usable FROM q""")
def native_text_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", layout.text_quality(F.coalesce("text", F.lit(""))).alias("q")).select("doc_id", "q.*")


@register(r"""WITH l AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
p AS (SELECT doc_id, ls, CASE WHEN len(ls) <= 3 THEN range(len(ls)) ELSE list_distinct([0, CAST(round_even((len(ls) - 1) / 2, 0) AS BIGINT), len(ls) - 1]) END AS pts FROM l),
c AS (SELECT doc_id, list_sum(list_transform(pts, lambda i: length(regexp_replace(ls[i + 1], '[ \t-\r]', '', 'g')))) AS n FROM p)
SELECT doc_id, CAST(n AS BIGINT) AS sampled_chars, CASE WHEN n > 100 THEN 'native' ELSE 'scanned' END AS route FROM c""")
def document_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", F.split(F.coalesce("text", F.lit("")), "\\n").alias("ls"))
    sampled = F.transform(layout.sample_pages(F.size("ls").cast("long")), lambda i: F.length(F.regexp_replace(F.get("ls", i.cast("int")), "[ \\t-\\r]", "")))
    n = F.aggregate(sampled, F.lit(0).cast("long"), lambda s, x: s + x)
    return rows.select("doc_id", n.alias("sampled_chars"), F.when(n > 100, "native").otherwise("scanned").alias("route"))


@register(rf"""WITH {ARTICLES} SELECT ordinal AS doc_id, {KEY.format("title")} AS key,
coalesce(nullif(regexp_replace(left(regexp_replace(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 80), '^$', ''), ''), 'paper') AS slug,
coalesce(nullif(trim(left(trim(regexp_replace(title, '[^\p{{L}}\p{{N}} _-]', '', 'g')), 30)), ''), 'Article') AS safe_title,
left(regexp_replace(title, '[^A-Za-z0-9]+', '_', 'g'), 80) AS stem FROM a""")
def title_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("title")
    return articles(spark, sf_dir).select(F.col("ordinal").alias("doc_id"), X.label_key(t).alias("key"), X.slug(t, "paper", 80).alias("slug"), X.safe_title(t).alias("safe_title"), X.safe_stem(t).alias("stem"))


NAMES = """CASE o_orderkey % 6 WHEN 0 THEN 'Wall Street Journal ' || strftime(d, '%Y-%m-%d') || '.pdf'
  WHEN 1 THEN 'FT_' || strftime(d, '%Y') || '_' || month(d) || '_' || day(d) || '.pdf'
  WHEN 2 THEN 'Barron''s ' || monthname(d) || ' ' || day(d) || ', 20' || strftime(d, '%y') || '.pdf'
  WHEN 3 THEN '[x] The Economist ' || left(monthname(d), 3) || '-' || day(d) || '-20' || strftime(d, '%y') || '.pdf'
  WHEN 4 THEN 'weekly 2024-13-45.pdf' ELSE 'left over.pdf' END"""


@register(f"""WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders), n AS (SELECT o_orderkey, d, {NAMES} AS name FROM o)
SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN 'WSJ' WHEN o_orderkey % 6 = 1 THEN 'FT' WHEN o_orderkey % 6 = 2 THEN 'BARRONS' WHEN o_orderkey % 6 = 3 THEN 'TE' ELSE 'General' END AS kind,
CASE WHEN o_orderkey % 6 > 3 THEN NULL WHEN o_orderkey % 6 > 1 THEN make_date(2000 + year(d) % 100, month(d), day(d)) WHEN year(d) >= 2000 THEN d END AS day FROM n""")
def filename_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    k, f = F.col("o_orderkey") % 6, lambda p: F.date_format("d", p)
    name = (
        F.when(k == 0, F.concat(F.lit("Wall Street Journal "), f("yyyy-MM-dd"), F.lit(".pdf")))
        .when(k == 1, F.concat(F.lit("FT_"), f("yyyy_M_d"), F.lit(".pdf")))
        .when(k == 2, F.concat(F.lit("Barron's "), f("MMMM d, '20'yy"), F.lit(".pdf")))
        .when(k == 3, F.concat(F.lit("[x] The Economist "), f("MMM-d-'20'yy"), F.lit(".pdf")))
        .when(k == 4, F.lit("weekly 2024-13-45.pdf"))
        .otherwise(F.lit("left over.pdf"))
    )
    # Apostrophes part words, so the key of the third name is barron s.
    return orders.withColumn("name", name).select("o_orderkey", dates.publication_type(F.col("name")).alias("kind"), dates.publication_date(F.col("name")).alias("day"))


@register(r"""WITH l AS (SELECT doc_id, list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_replace(x, '^[ \t-\r]+|[ \t-\r]+$', '', 'g')), lambda x: x <> '') AS ls FROM documents)
SELECT doc_id, 'doc' || doc_id || '_p' || i AS para_id, ls[i] AS en_text FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM l)""")
def paragraph_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(X.lines(F.coalesce("text", F.lit("")))).alias("i", "en_text"))
    return rows.select("doc_id", F.concat(F.lit("doc"), F.col("doc_id"), F.lit("_p"), F.col("i") + 1).alias("para_id"), "en_text")


@register(r"""WITH s AS (SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '[ \t-\r]+', ' ', 'g')) AS t FROM documents),
p AS (SELECT doc_id, string_split(regexp_replace(regexp_replace(t, '([.!?。！？]) ([A-Z“‘"\x27])', '\1' || chr(1) || '\2', 'g'), '([.!?。！？]) ([A-Z“‘"\x27])', '\1' || chr(1) || '\2', 'g'), chr(1)) AS parts FROM s),
f AS (SELECT doc_id, list_reduce(list_transform(parts, lambda x: {'out': CAST([] AS VARCHAR[]), 'cur': x, 'n': len(list_filter(string_split(x, ' '), lambda w: w <> '')), 'done': false}),
  lambda s, x: CASE WHEN s.n >= 90 THEN {'out': list_append(s.out, s.cur), 'cur': x.cur, 'n': x.n, 'done': false} ELSE {'out': s.out, 'cur': s.cur || ' ' || x.cur, 'n': s.n + x.n, 'done': false} END) AS r FROM p),
o AS (SELECT doc_id, list_append(r.out, r.cur) AS ps FROM f)
SELECT doc_id, i AS place, ps[i] AS paragraph FROM (SELECT doc_id, ps, unnest(range(1, len(ps) + 1)) AS i FROM o)""")
def sentence_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = X.sentence_pack(X.sentences(X.squeeze(F.coalesce("text", F.lit("")))))
    rows = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(packed).alias("i", "paragraph"))
    return rows.select("doc_id", (F.col("i") + 1).cast("long").alias("place"), "paragraph")


@register(r"SELECT doc_id, regexp_replace(regexp_replace(coalesce(text, ''), '[ \t-\r]*\n[ \t-\r]*', ' ', 'g'), '^[ \t-\r]+|[ \t-\r]+$', '', 'g') AS line FROM documents")
def line_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", X.flatten_lines(F.coalesce("text", F.lit(""))).alias("line"))


@register(r"SELECT page_id, trim(regexp_replace(regexp_replace(coalesce(html, ''), '<[^>]*>', ' ', 'g'), '[ \t-\r]+', ' ', 'g')) AS text FROM pages")
def html_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", X.strip_tags(F.coalesce("html", F.lit(""))).alias("text"))


@register(r"""WITH l AS (SELECT conv_id, string_agg(repeat('#', CAST(turn % 4 + 1 AS INT)) || ' ' || role || chr(10) || text, chr(10) ORDER BY turn) AS t FROM conversations GROUP BY conv_id),
p AS (SELECT conv_id, list_filter(string_split(regexp_replace(t, '(?m)^(#{1,3} )', chr(1) || '\1', 'g'), chr(1)), lambda x: regexp_matches(x, '^#{1,3} ')) AS ps FROM l)
SELECT conv_id, i AS section, regexp_replace(split_part(ps[i], chr(10), 1), '^#{1,3} ', '') AS title,
regexp_replace(substr(ps[i], strpos(ps[i] || chr(10), chr(10)) + 1), '^[ \t-\r]+|[ \t-\r]+$', '', 'g') AS body FROM (SELECT conv_id, ps, unnest(range(1, len(ps) + 1)) AS i FROM p)""")
def markdown_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.concat(F.repeat(F.lit("#"), (F.col("turn") % 4 + 1).cast("int")), F.lit(" "), F.col("role"), F.lit("\n"), F.col("text"))
    rows = table(spark, sf_dir, "conversations").filter("text is not null and role is not null").select("conv_id", F.struct("turn", part.alias("t")).alias("x"))
    whole = rows.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["t"]), "\n").alias("t"))
    found = whole.select("conv_id", F.posexplode(X.markdown_sections(F.col("t"))).alias("i", "s"))
    return found.select("conv_id", (F.col("i") + 1).cast("long").alias("section"), "s.title", "s.body")


@register(r"""WITH s AS (SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '[ \t-\r]+', ' ', 'g')) AS t FROM documents),
h AS (SELECT doc_id, t, left(substr(t, 11, 40), 20) AS head, right(substr(t, 101, 40), 20) AS tail FROM s),
b AS (SELECT *, strpos(t, trim(head)) AS b FROM h), e AS (SELECT *, CASE WHEN b > 0 THEN strpos(substr(t, b), right(trim(regexp_replace(substr(t, 101, 40), '[ \t-\r]+', ' ', 'g')), 20)) END AS e, left(trim(substr(t, 11, 40)), 20) AS hd, right(trim(substr(t, 101, 40)), 20) AS tl FROM b),
f AS (SELECT *, strpos(t, hd) AS fb FROM e), g AS (SELECT *, strpos(substr(t, fb), tl) AS fe FROM f WHERE fb > 0 AND hd <> '' AND tl <> '')
SELECT doc_id, substr(t, fb, fe - 1 + length(tl)) AS slice FROM g WHERE fe > 0""")
def anchor_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = X.squeeze(F.coalesce("text", F.lit("")))
    rows = table(spark, sf_dir, "documents").select("doc_id", t.alias("t"))
    found = X.anchor_slice(F.col("t"), F.substring("t", 11, 40), F.substring("t", 101, 40))
    return rows.select("doc_id", found.alias("slice")).filter("slice is not null")


@register(rf"""WITH {ARTICLES} SELECT ordinal AS doc_id, CAST(len(list_distinct(list_transform(list_filter(regexp_extract_all(regexp_replace(lower(title || ' ' || body), '([a-z])-[ \t-\r]+([a-z])', '\1\2', 'g'), '[a-z0-9]+'),
  lambda x: length(x) >= 3 AND x NOT IN {linking.V.STOP_WORDS}), lambda x: CASE WHEN length(x) > 4 AND x LIKE '%ies' THEN left(x, length(x) - 3) || 'y' WHEN length(x) > 4 AND x LIKE '%s' AND x NOT LIKE '%ss' THEN left(x, length(x) - 1) ELSE x END))) AS BIGINT) AS n_tokens FROM a""")
def link_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles(spark, sf_dir).select(F.col("ordinal").alias("doc_id"), F.size(X.link_tokens(F.concat_ws(" ", "title", "body"))).cast("long").alias("n_tokens"))


CLEANUPS = [
    (1, "H E A D lines. Turn to page A5 now."),
    (2, "He said so. continued from page one The end."),
    (3, "A well- known man. Please turn to page 12"),
    (4, "Plain.  Two   spaces. B"),
]


@register("SELECT * FROM (VALUES (1, 'HEAD lines. now.'), (2, 'He said so. The end.'), (3, 'A well-known man.'), (4, 'Plain. Two spaces. B')) t(id, text)")
def paragraph_cleanup_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.createDataFrame(CLEANUPS, "id int, text string")
    return rows.select("id", F.array_join(X.clean_paragraphs(F.col("text")), "\n\n").alias("text"))


MARKS = [(1, "Rates rise (Continued)"), (2, "Oil — Continued"), (3, "Bonds"), (4, "Story ends here. B"), (5, "中文。短句！English?")]


@register("SELECT * FROM (VALUES (1, 'Rates rise', true, 'Rates rise (Continued)', 0, 1), (2, 'Oil', true, 'Oil — Continued', 0, 1), (3, 'Bonds', false, 'Bonds', 0, 1), (4, 'Story ends here. B', false, 'Story ends here.', 0, 1), (5, '中文。短句！English?', false, '中文。短句！English?', 4, 3)) t(id, base, continued, unmarked, n_cjk, n_sentences)")
def mark_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    rows = spark.createDataFrame(MARKS, "id int, text string")
    return rows.select("id", X.continued_base(t).alias("base"), X.is_continued(t).alias("continued"), X.end_mark(t).alias("unmarked"), X.cjk_count(t).cast("int").alias("n_cjk"), F.size(X.cjk_sentences(t)).alias("n_sentences"))


SELECTORS = [("2,4-6",), ("6-4, 1",), ("3,3,2-3",)]


@register("SELECT * FROM (VALUES ('2,4-6', '2,4,5,6'), ('6-4, 1', '1,4,5,6'), ('3,3,2-3', '2,3')) t(selector, pages)")
def page_selectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.createDataFrame(SELECTORS, "selector string")
    return rows.select("selector", F.array_join(files.pages_of_selector(F.col("selector")).cast("array<string>"), ",").alias("pages"))


@register("SELECT s_suppkey, lower(s_name) IN ('supplier#000000003') OR regexp_matches(lower(s_name), '^.*#00000001.$') AS selected FROM supplier")
def name_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select("s_suppkey", files.name_selector(F.col("s_name"), F.col("s_name"), ["Supplier#000000003, *#00000001?"]).alias("selected"))


@register(rf"""WITH {ARTICLES} SELECT ordinal AS doc_id, '# ' || coalesce(nullif(title, ''), 'Untitled') || chr(10) || chr(10) || '- Category: ' || category || chr(10) || '- Page: ' || page || CASE WHEN body <> '' THEN chr(10) || chr(10) || body ELSE '' END AS markdown FROM a WHERE category IS NOT NULL AND category <> ''""")
def article_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = articles(spark, sf_dir).filter("category is not null and category <> ''")
    return rows.select(F.col("ordinal").alias("doc_id"), exports.article_markdown(F.col("title"), F.col("category"), F.col("page"), F.col("body")).alias("markdown"))


@register()
def tolerant_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("<think>{</think> Here: ```json\n"), F.col("props"), F.lit("\n``` done")).alias("reply"))
    return rows.select("event_id", fuzzy.tolerant_json(F.col("reply")).alias("parsed"))


@register(r"SELECT page_id, replace(replace(replace(replace(replace(coalesce(html, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), chr(34), '&quot;'), chr(39), '&#39;') AS escaped FROM pages")
def html_escape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", X.escape_html(F.coalesce("html", F.lit(""))).alias("escaped"))


@register("SELECT item_id, CAST(round(greatest(0, least(x1, h1) - greatest(x0, h0)) / greatest(least(x1 - x0, h1 - h0), 1), 4) AS DOUBLE) AS share FROM (SELECT item_id, CAST(item_id % 50 AS DOUBLE) AS x0, CAST(item_id % 50 + 30 AS DOUBLE) AS x1, 20.0::DOUBLE AS h0, 60.0::DOUBLE AS h1 FROM benchmark)")
def box_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    x0 = (F.col("item_id") % 50).cast("double")
    return table(spark, sf_dir, "benchmark").select("item_id", F.round(geometry.overlap_share(x0, x0 + 30, F.lit(20.0), F.lit(60.0)), 4).alias("share"))
