"""Queries on page geometry and page text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.operators import layout
from broadsheet.plans.registry import Registry, table

register = Registry()

#: Blocks with made-up places: each line of a document is a block on its page.
BLOCKS = r"""b AS (SELECT doc_id AS page, i AS ordinal, 'b' || i AS id, CAST((doc_id * 7 + i * 131) % 600 AS DOUBLE) AS x0, CAST((doc_id * 3 + i * 57) % 1100 AS DOUBLE) AS y0, ls[i] AS text, 634.0::DOUBLE AS width, 1219.0::DOUBLE AS height
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)))"""


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("page"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\\n")).alias("n", "text"))
    i = F.col("n") + 1
    place = lambda a, b, m: ((F.col("page") * a + i * b) % m).cast("double")
    rows = lines.select("page", i.cast("long").alias("ordinal"), F.concat(F.lit("b"), i).alias("id"), place(7, 131, 600).alias("x0"), place(3, 57, 1100).alias("y0"), "text", F.lit(634.0).alias("width"), F.lit(1219.0).alias("height"))
    return rows.withColumns({"x1": F.col("x0") + 90, "y1": F.col("y0") + 25})


@register(rf"""WITH RECURSIVE {BLOCKS}, l AS (SELECT page, list({{'x0': x0, 'y0': y0, 'id': id}} ORDER BY x0, y0, id) AS bs FROM b GROUP BY page),
f(page, bs, i, leaders, col) AS (SELECT page, bs, 0, CAST([] AS DOUBLE[]), 0 FROM l
  UNION ALL SELECT page, bs, i + 1, CASE WHEN hit IS NULL THEN list_append(leaders, bs[i + 1].x0) ELSE leaders END, coalesce(hit, len(leaders) + 1)
  FROM (SELECT page, bs, i, leaders, list_filter(range(1, len(leaders) + 1), lambda j: abs(leaders[j] - bs[i + 1].x0) <= 32)[1] AS hit FROM f WHERE i < len(bs))),
c AS (SELECT page, bs[i].id AS id, bs[i].y0 AS y0, CAST(col AS BIGINT) AS "column" FROM f WHERE i > 0)
SELECT page, id, "column", row_number() OVER (PARTITION BY page ORDER BY "column", y0, id) AS place FROM c""")
def column_reading_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.column_order(blocks(spark, sf_dir))


@register(rf"WITH {BLOCKS} SELECT page, id, CAST(least(floor(greatest(x0, 0) / greatest(width / 4, 1)), 3) AS BIGINT) AS quarter FROM b")
def quarter_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks(spark, sf_dir).select("page", "id", layout.quarter_column(F.col("x0"), F.col("width")).alias("quarter"))


@register(rf"WITH {BLOCKS} SELECT page, id, row_number() OVER (PARTITION BY page ORDER BY y0, x0, ordinal) AS place FROM b WHERE y0 <= 125 AND y0 + 25 <= 160")
def header_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.header_band(blocks(spark, sf_dir)).select("page", "id", "place")


@register(rf"""WITH {BLOCKS}, x AS (SELECT *, x0 + 90 AS x1, y0 + 25 AS y1 FROM b), h AS (SELECT page, id AS heading, ordinal AS ho, x0 AS hx0, x1 AS hx1, y1 AS hy1 FROM x WHERE ordinal % 4 = 1),
p AS (SELECT x.page, x.id, heading, ho, y0 - hy1 AS gap, abs((x0 + x1 - hx0 - hx1) / 2) AS apart, greatest(0, least(x1, hx1) - greatest(x0, hx0)) / greatest(least(x1 - x0, hx1 - hx0), 1) AS share FROM x JOIN h ON x.page = h.page WHERE ordinal % 4 <> 1),
s AS (SELECT page, id, heading, ho, round(gap + 0.18 * apart - 60 * share, 4) AS score FROM p WHERE gap >= -2 AND gap <= 900 AND share >= 0.12),
r AS (SELECT *, row_number() OVER (PARTITION BY page, id ORDER BY score, ho) AS r FROM s) SELECT page, id, heading, score FROM r WHERE r = 1""")
def heading_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = blocks(spark, sf_dir)
    return layout.assign_headings(rows.filter("ordinal % 4 <> 1"), rows.filter("ordinal % 4 = 1"))


@register(rf"""WITH {BLOCKS}, h AS (SELECT * FROM b WHERE ordinal % 4 = 1), i AS (SELECT page, id AS image, x0 AS ix, y0 AS iy FROM b WHERE ordinal % 4 = 2),
d AS (SELECT h.page, h.id AS heading, image, round(abs(x0 - ix) / width + abs(y0 - iy) / height, 4) AS distance FROM h JOIN i ON h.page = i.page),
r AS (SELECT *, row_number() OVER (PARTITION BY page, heading ORDER BY distance, image) AS r FROM d WHERE distance < 0.45) SELECT page, heading, image, distance FROM r WHERE r = 1""")
def nearest_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = blocks(spark, sf_dir)
    return layout.nearest_image(rows.filter("ordinal % 4 = 1"), rows.filter("ordinal % 4 = 2"))


@register("""WITH s AS (SELECT user_id AS page, event_id % 40 AS block, event_id % 3 AS line, floor(value) AS size, event_type = 'error' AS bold FROM events),
b AS (SELECT page, block, max(size) AS max_font_size, round(median(size), 2) AS median_font_size, bool_or(bold) AS bold FROM s GROUP BY ALL)
SELECT page, printf('b%03d', row_number() OVER (PARTITION BY page ORDER BY block)) AS id, max_font_size, median_font_size, bold FROM b""")
def native_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    spans = e.select(F.col("user_id").alias("page"), (F.col("event_id") % 40).alias("block"), (F.col("event_id") % 3).alias("line"), *[F.floor("value").cast("double").alias(c) for c in ("x0", "y0", "x1", "y1", "size")], F.col("event_type").alias("text"), (F.col("event_type") == "error").alias("bold"))
    return layout.blocks_of_spans(spans).select("page", "id", "max_font_size", "median_font_size", "bold")


HEADINGS = [
    (1, "Contents\nMore", "TE", "contents"),
    (2, "The world this week\nPolitics", "TE", "world_this_week_politics"),
    (3, "The World This Week | Business", "TE", "world_this_week_business"),
    (4, "INDEX", "BARRONS", "utility"),
    (5, "INDEX", "WSJ", "normal"),
    (6, "Winners & Losers", "barrons", "utility"),
    (7, "DATA\nbarrons.com/data", "BARRONS", "utility"),
    (8, "a\nb\nc\nd\ne\nf\nContents", "TE", "normal"),
]


@register("SELECT * FROM (VALUES " + ", ".join(f"({i}, '{t}')" for i, _, _, t in HEADINGS) + ") t(id, kind)")
def page_type_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.createDataFrame([x[:3] for x in HEADINGS], "id int, heading string, publication string")
    return rows.select("id", layout.page_type(F.col("heading"), F.col("publication")).alias("kind"))


LABELS = [(1, "A12"), (2, "b3 | Tuesday"), (3, "A10 WORLD NEWS"), (4, "Monday, July 27 | R1"), (5, "The Wall Street Journal. A4"), (6, "Plain line"), (7, "A1 Something")]


@register("SELECT * FROM (VALUES (1, 'A12'), (2, 'B3'), (3, 'A10'), (4, 'R1'), (5, 'A4'), (6, NULL), (7, NULL)) t(id, label)")
def print_label_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame(LABELS, "id int, line string").select("id", layout.print_label(F.col("line")).alias("label"))


WEEKENDS = [(1, "FT", "FT  Weekend 25 July"), (2, "WSJ", "The Wall Street Journal Weekend"), (3, "WSJ", "Saturday / Sunday, July 25"), (4, "TE", "Saturday/Sunday"), (5, "FT", "Monday"), (6, "FT", "Saturday 25 July / Sunday 26 July")]


@register("SELECT * FROM (VALUES (1, true), (2, true), (3, true), (4, false), (5, false), (6, true)) t(id, weekend)")
def weekend_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame(WEEKENDS, "id int, p string, h string").select("id", layout.is_weekend(F.col("p"), F.col("h")).alias("weekend"))


DIRECTORY = [
    "Front", "What’s", "News", "noise", "Business & Finance", "• Shares of a maker", "fell on Monday, A2", "left over", "• No label here", "Worldwide", "• Leaders met in the capital. A10", "• Voters chose B4.", "Contents", "• Not this A1",
]


@register("""WITH k AS (SELECT DISTINCT conv_id AS page FROM conversations)
SELECT page, 1 AS group_no, 'Business & Finance' AS "group", 1 AS item_no, 'Shares of a maker fell on Monday' AS text, 'A2' AS label FROM k
UNION ALL SELECT page, 2, 'Worldwide', 1, 'Leaders met in the capital', 'A10' FROM k UNION ALL SELECT page, 2, 'Worldwide', 2, 'Voters chose', 'B4' FROM k""")
def directory_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("page")).distinct()
    lines = pages.select("page", F.posexplode(F.array(*map(F.lit, DIRECTORY))).alias("line_no", "line"))
    found = layout.parse_directory(lines)
    return found.select("page", F.col("group_no").cast("int").alias("group_no"), "group", F.col("item_no").cast("int").alias("item_no"), "text", "label")


@register("""SELECT c_mktsegment AS issue, min(c_custkey) AS pdf_page FROM customer WHERE c_custkey % 7 = 1 AND c_nationkey % 2 = 0 GROUP BY c_mktsegment""")
def front_page_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    pages = c.select(F.col("c_mktsegment").alias("issue"), F.col("c_custkey").alias("pdf_page"), F.when(F.col("c_nationkey") % 2 == 0, "WSJ").otherwise("TE").alias("publication_type"), F.when(F.col("c_custkey") % 7 == 1, "A1").otherwise("B2").alias("print_page_label"), F.lit(1).alias("n_groups"))
    return layout.front_page(pages)
