"""Queries on work to do, sources of the index, images and what readers see of articles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.operators import articles as A
from broadsheet.operators import folds, images, issues, reader
from broadsheet.plans.registry import Registry, table
from broadsheet.plans.text_queries import articles

register = Registry()


@register()
def cross_page_continuations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole cross-page merge. Its like titles are a ratio that SQL lacks: tests compare it with a loop."""
    return A.merge_continuations(articles(spark, sf_dir)).withColumn("source_pages", F.array_join(F.col("source_pages").cast("array<string>"), ","))


@register("""WITH n AS (SELECT doc_id, source, lower(substr(coalesce(text, ''), 1, 1)) AS base FROM documents)
SELECT doc_id, source, CASE WHEN row_number() OVER w = 1 THEN base ELSE base || '_' || row_number() OVER w END AS name FROM n WINDOW w AS (PARTITION BY source, base ORDER BY doc_id)""")
def free_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", F.lower(F.substring(F.coalesce("text", F.lit("")), 1, 1)).alias("base"))
    return folds.free_names(rows, ["source"], "base", "doc_id").select("doc_id", "source", "name")


RECTS = """SELECT o_custkey AS page, o_orderkey AS position, o_orderkey % 7 AS xref, 0.0::DOUBLE AS x0, 0.0::DOUBLE AS y0, (o_orderkey % 211)::DOUBLE AS x1, (o_orderkey % 97)::DOUBLE AS y1 FROM orders"""


@register(f"""WITH r AS ({RECTS}), b AS (SELECT page, xref, min(position) AS position, arg_max(x1, x1 * y1 * 10000000000 - position) AS x1, arg_max(y1, x1 * y1 * 10000000000 - position) AS y1 FROM r WHERE x1 > 0 AND y1 > 0 GROUP BY ALL)
SELECT page, xref, row_number() OVER (PARTITION BY page ORDER BY position) AS image, x1, y1 FROM b WHERE x1 >= 45 AND y1 >= 30 AND x1 * y1 / 480000.0 >= 0.0025""")
def native_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    rects = o.select(F.col("o_custkey").alias("page"), F.col("o_orderkey").alias("position"), (F.col("o_orderkey") % 7).alias("xref"), F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), (F.col("o_orderkey") % 211).cast("double").alias("x1"), (F.col("o_orderkey") % 97).cast("double").alias("y1"), F.lit(600.0).alias("page_width"), F.lit(800.0).alias("page_height"))
    return images.native_images(rects).select("page", "xref", "image", "x1", "y1")


@register("""SELECT user_id AS issue, string_agg(DISTINCT event_id % 40, ',' ORDER BY event_id % 40) AS pages FROM events WHERE event_id % 40 > 0 AND (value < 20 OR event_type = 'click') GROUP BY ALL""")
def pages_to_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed pages (low values) and pending ones (clicks) of each user's events, as one set."""
    page = table(spark, sf_dir, "events").select(F.col("user_id").alias("issue"), (F.col("event_id") % 40).alias("page"), "value", "event_type")
    found = issues.pages_to_retry(page.filter("value < 20"), page.filter("event_type = 'click'"))
    return found.select("issue", F.array_join(F.col("pages").cast("array<string>"), ",").alias("pages"))


@register("""WITH p AS (SELECT DISTINCT conv_id AS issue, turn AS page FROM conversations), c AS (SELECT DISTINCT conv_id AS issue, turn AS page FROM conversations WHERE role = 'user')
SELECT p.issue, p.page, c.page IS NOT NULL AS cached, row_number() OVER (PARTITION BY p.issue ORDER BY c.page IS NOT NULL, p.page) AS place FROM p LEFT JOIN c ON p.issue = c.issue AND p.page = c.page""")
def work_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("issue"), F.col("turn").alias("page"), "role")
    return issues.work_order(page.select("issue", "page").distinct(), page.filter("role = 'user'")).select("issue", "page", "cached", "place")


@register("""SELECT conv_id AS issue, coalesce(bool_or(turn = 1 AND role = 'user'), false) AS weekend FROM conversations GROUP BY ALL""")
def weekend_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return issues.weekend_issues(table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("issue"), F.col("turn").alias("page"), (F.col("role") == "user").alias("is_weekend")))


@register("""WITH b AS (SELECT CAST(p_partkey AS VARCHAR) AS id, p_brand AS publication_type, CAST(p_size AS VARCHAR) AS publication_date, p_name AS database_path, p_retailprice AS n, 0 AS src FROM part
  UNION ALL SELECT CASE WHEN p_partkey % 2 = 0 THEN CAST(p_partkey AS VARCHAR) ELSE '' END, p_brand, CAST(p_size AS VARCHAR), p_name || p_partkey, p_retailprice + 1, 1 FROM part),
k AS (SELECT *, CASE WHEN id = '' THEN publication_type || '|' || publication_date || '|' || database_path ELSE id END AS key FROM b)
SELECT arg_max(id, src) AS id, arg_max(publication_type, src) AS publication_type, arg_max(publication_date, src) AS publication_date, arg_max(database_path, src) AS database_path, arg_max(n, src) AS n FROM k GROUP BY key""")
def index_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    row = lambda id_, path, n: part.select(id_.alias("id"), F.col("p_brand").alias("publication_type"), F.col("p_size").cast("string").alias("publication_date"), path.alias("database_path"), n.alias("n"))
    own = F.col("p_partkey").cast("string")
    return issues.sources_union(row(own, F.col("p_name"), F.col("p_retailprice")), row(F.when(F.col("p_partkey") % 2 == 0, own).otherwise(""), F.concat("p_name", own), F.col("p_retailprice") + 1))


@register("""WITH i AS (SELECT conv_id, list('img' || turn ORDER BY turn) AS images FROM conversations GROUP BY ALL) SELECT conv_id, array_to_string(images[1:6], ',') AS images FROM i""")
def image_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list("turn")), lambda t: F.concat(F.lit("img"), t.cast("string"))).alias("images"))
    return c.select("conv_id", F.array_join(images.capped(F.col("images")), ",").alias("images"))


@register(r"""SELECT doc_id, '### 基本信息' || chr(10) || '- 版面：' || coalesce(source, '未知') || chr(10) || '- 分类：' || coalesce(lang, 'General') || chr(10) || '- PDF 页码：' || CASE WHEN doc_id = 0 THEN '未知' ELSE CAST(doc_id AS VARCHAR) END || chr(10)
  || '- 正文字数：约 ' || len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) || ' words' || chr(10) || chr(10) || '### 处理状态' || chr(10) || '- 当前文章使用本地段落整理，暂无中文深度解读。' AS summary FROM documents""")
def local_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", F.lit(None).cast("string").alias("label"), F.col("source").alias("section"), F.col("lang").alias("category"), F.col("doc_id").alias("page"), F.col("text").alias("body"), F.lit(False).alias("compiled"))
    return d.select("doc_id", reader.local_summary(d).alias("summary"))
