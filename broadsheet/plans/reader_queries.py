"""Queries of the reader and of ingestion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from broadsheet.operators import reader
from broadsheet.plans.registry import Registry, table
from broadsheet.plans.text_queries import ARTICLES, articles
from broadsheet.sources import files
from broadsheet.streaming import ingest

register = Registry()


@register("""WITH i AS (SELECT o_orderpriority AS kind, o_orderkey AS id, CAST(o_orderdate AS DATE) AS d, o_custkey AS n FROM orders)
SELECT kind AS publication_type, count(*) AS issues, CAST(sum(n) AS BIGINT) AS articles, max((d, id)).id AS latest_id, max(d) AS latest_date FROM (SELECT kind, n, {'d': d, 'id': id} AS s, d, id FROM i) GROUP BY kind""".replace("max((d, id)).id", "max({'d': d, 'id': id}).id"))
def index_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("publication_type"), F.col("o_orderkey").alias("id"), F.to_date("o_orderdate").alias("publication_date"), F.col("o_custkey").cast("long").alias("article_count"))
    return reader.publication_summary(index)


@register(rf"""WITH {ARTICLES} SELECT issue, count(*) AS n, count_if(contains(lower(title), 'license')) AS in_title FROM a WHERE contains(lower(concat_ws(' ', title, category, body)), 'license') GROUP BY issue""")
def reader_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reader.search(articles(spark, sf_dir), reader.search_text(F.col("title"), F.col("category"), F.col("body")), "License")
    return found.groupBy("issue").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.contains(F.lower("title"), F.lit("license"))).alias("in_title"))


@register("""SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'A' || c_nationkey || ' · ' || s WHEN c_custkey % 4 = 1 THEN c_mktsegment || ' OF THE UK' WHEN c_custkey % 4 = 2 THEN 'A' || c_nationkey || ' · Section unknown' ELSE 'PDF ' || c_custkey || ' · ' || s END AS heading
FROM (SELECT *, upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) || ' of the UK' AS s FROM customer)""")
def page_heading_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey") % 4
    section = F.when(k != 2, F.concat("c_mktsegment", F.lit(" OF THE UK")))
    label = F.when((k == 0) | (k == 2), F.concat(F.lit("A"), F.col("c_nationkey")))
    return table(spark, sf_dir, "customer").select("c_custkey", reader.page_heading(section, label, F.col("c_custkey"), F.when(k == 1, "section_only")).alias("heading"))


@register("""WITH g AS (SELECT source AS issue, lang AS category, count(*) AS n, min(doc_id) AS first FROM documents GROUP BY ALL) SELECT issue, category, n, row_number() OVER (PARTITION BY issue ORDER BY first) AS position FROM g""")
def category_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reader.category_contents(articles(spark, sf_dir))


@register("SELECT conv_id AS issue, turn AS ordinal, lag(turn) OVER w AS previous, lead(turn) OVER w AS next FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)")
def article_navigation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reader.neighbours(table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("issue"), F.col("turn").alias("ordinal")))


@register("""WITH a AS (SELECT conv_id AS issue, turn AS ordinal, role AS label, 's' || turn % 2 AS section, turn // 3 AS page FROM conversations), g AS (SELECT issue, label, section, page, min(ordinal) AS first, count(*) AS n FROM a GROUP BY ALL)
SELECT issue, label, section, page, first, n, row_number() OVER (PARTITION BY issue ORDER BY first) AS page_order FROM g""")
def fallback_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("issue"), F.col("turn").alias("ordinal"), F.col("role").alias("label"), F.concat(F.lit("s"), F.col("turn") % 2).alias("section"), F.expr("turn div 3").alias("page"))
    return reader.pages_from_articles(rows)


@register("""WITH a AS (SELECT conv_id AS issue, turn AS ordinal, CASE WHEN turn % 3 = 0 THEN 'p' || turn % 2 ELSE 'none' END AS label, turn AS page FROM conversations),
p AS (SELECT DISTINCT conv_id AS issue, turn % 4 AS pdf_page, 'P' || turn % 2 AS label FROM conversations), l AS (SELECT issue, label, min(pdf_page) AS pp FROM p GROUP BY ALL), m AS (SELECT issue, max(pdf_page) AS last FROM p GROUP BY issue)
SELECT a.issue, a.ordinal, coalesce(l.pp, q.pdf_page, m.last) AS pdf_page, CASE WHEN l.pp IS NOT NULL THEN 'label' WHEN q.pdf_page IS NOT NULL THEN 'page' ELSE 'last' END AS how
FROM a LEFT JOIN l ON a.issue = l.issue AND upper(a.label) = l.label LEFT JOIN (SELECT DISTINCT issue, pdf_page FROM p) q ON a.issue = q.issue AND a.page = q.pdf_page LEFT JOIN m ON a.issue = m.issue""")
def primary_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("issue"), F.col("turn").alias("ordinal"))
    rows = c.withColumn("label", F.when(F.col("ordinal") % 3 == 0, F.concat(F.lit("p"), F.col("ordinal") % 2)).otherwise("none")).withColumn("page", F.col("ordinal"))
    pages = c.select("issue", (F.col("ordinal") % 4).alias("pdf_page"), F.concat(F.lit("P"), F.col("ordinal") % 2).alias("label")).distinct()
    return reader.primary_page(rows, pages)


@register("""SELECT l_orderkey AS article, l_partkey AS glossary_id, p_type AS surface, l_linenumber AS paragraph, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, length(p_type) DESC, l_partkey) AS place FROM lineitem JOIN part ON l_partkey = p_partkey""")
def annotation_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("glossary_id"), F.col("p_type").alias("surface"))
    notes = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("article"), F.col("l_partkey").alias("glossary_id"), F.col("l_linenumber").alias("paragraph"))
    return reader.annotations_of(notes, part).select("article", "glossary_id", "surface", "paragraph", "place")


@register("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS r FROM events WHERE value >= 100 AND ts <= TIMESTAMP '2024-01-05 00:00:00')
SELECT event_type, event_id FROM r WHERE r = 1""")
def ingest_readiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").filter("value >= 100 and ts <= timestamp'2024-01-05'")
    return rows.groupBy("event_type").agg(F.max(F.struct("ts", "event_id"))["event_id"].alias("event_id"))


@register("""SELECT event_id AS key, r AS round, ts + to_seconds(CASE r WHEN 1 THEN 30 WHEN 2 THEN 120 ELSE 300 END) AS due FROM events, (SELECT unnest([1, 2, 3])::BIGINT AS r) WHERE event_type = 'error'""")
def retry_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = table(spark, sf_dir, "events").filter("event_type = 'error'").select(F.col("event_id").alias("key"), F.col("ts").cast("timestamp").alias("failed_at"))
    return ingest.retry_schedule(failed).withColumn("due", F.col("due").cast("timestamp_ntz"))


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    # A stream reads a folder: the one file (or folder of files) of the table is picked by its name.
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").parquet(f"{sf_dir}/events.parquet*")


@register("SELECT DISTINCT user_id, event_type FROM events")
def ingest_dedupe_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = ingest.timed(_stream(spark, sf_dir)).select("user_id", "event_type", "ts")
    found = ingest.dedupe_stream(stream, ["user_id", "event_type"], "ts", "3650 days")
    return ingest.available_table(found, files.shared_folder(spark)).select("user_id", "event_type")


@register("SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def ingest_window_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = ingest.window_counts(ingest.timed(_stream(spark, sf_dir)), "ts", "1 day", "1 hour", "event_type")
    found = ingest.available_table(counts, files.shared_folder(spark), "complete")
    return found.withColumn("start", F.col("start").cast("timestamp_ntz"))


@register("""SELECT l_returnflag AS publication, l_linestatus AS section, count(*) AS articles, CAST(sum(l_linenumber) AS BIGINT) AS pages, row_number() OVER (PARTITION BY l_returnflag ORDER BY count(*) DESC, l_linestatus) AS place FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def section_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("publication"), F.col("l_linestatus").alias("section")).agg(F.count(F.lit(1)).alias("articles"), F.sum("l_linenumber").cast("long").alias("pages"))
    return found.withColumn("place", F.row_number().over(Window.partitionBy("publication").orderBy(F.col("articles").desc(), "section")).cast("long"))
