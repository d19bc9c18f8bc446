"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.llm.attribution import token_attribution
from broadsheet.llm.common import bounded_batches
from broadsheet.llm.langid import language_report
from broadsheet.llm.mixing import mixture
from broadsheet.llm.packing import pack, token_pieces
from broadsheet.llm.quality import quality_report
from broadsheet.llm.sharding import rendezvous_shards, shard_slots
from broadsheet.llm.simhash import simhash_components
from broadsheet.llm.sstable import token_table_report
from broadsheet.llm.syncmers import syncmer_report
from broadsheet.llm.warc import warc_report

SEQUENCE = 2048
WORD = "[^\\x20\\x09-\\x0D]+"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bounded_batches(spark).read.parquet(f"{sf_dir}/documents.parquet")


def op1_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"))
    placed = rendezvous_shards(rows, "doc_id", [1.0] * 16, grown="grown_shard")
    slotted = shard_slots(placed, "shard", ["doc_id"])
    return slotted.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op2_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_pieces(_documents(spark, sf_dir), tokenizer_path(), 1, SEQUENCE)
    # In plain documents every token bears loss but the first of a document, which nothing predicts.
    pieces = pieces.withColumn("segments", F.lit(1)).withColumn("loss_tokens", F.col("length") - (F.col("start") == 0).cast("long"))
    return pack(pieces, {"length": SEQUENCE, "segments": 128, "loss_tokens": SEQUENCE}, "length").drop("segments")


def op3_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(_documents(spark, sf_dir))


def op4_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc_report(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "warc_date")


OP4_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS d FROM pages),
q AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first_id FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(d, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31 AS BIGINT) + 1, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to,
  '2000-01-01T00:00:00Z' AS warc_date
FROM q
"""


def op5_temperature_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD))
    return mixture(_documents(spark, sf_dir), words, 1 << 20, target_entropy=0.98, repetition_limit=4.0)


#: The bisection is a fold over its steps; weights in whole millionths leave nothing to rounding after it.
OP5_SQL = r"""
WITH k AS (SELECT doc_id, source, greatest(CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT), 1) AS tokens,
    md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key FROM documents),
t AS (SELECT source, CAST(sum(tokens) AS BIGINT) AS size, ln(CAST(sum(tokens) AS DOUBLE)) AS l FROM k GROUP BY source),
a AS (SELECT list(l ORDER BY l) AS ls, max(l) AS top, min(l) AS low, 0.98 * ln(CAST(count(*) AS DOUBLE)) - 1e-12 AS goal FROM t),
RECURSIVE_ENTROPY AS (
  WITH RECURSIVE s(i, lo, hi) AS (
    SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
    UNION ALL
    SELECT i + 1, CASE WHEN e >= goal THEN mid ELSE lo END, CASE WHEN e >= goal THEN hi ELSE mid END
    FROM (SELECT i, lo, hi, mid, goal, ln(z) - w / z AS e FROM (
      SELECT i, lo, hi, (lo + hi) / 2 AS mid, goal,
        list_sum(list_transform(ls, lambda x: exp((lo + hi) / 2 * (x - top)))) AS z,
        list_sum(list_transform(ls, lambda x: exp((lo + hi) / 2 * (x - top)) * ((lo + hi) / 2) * (x - top))) AS w
      FROM s, a WHERE i < 50)))
  SELECT lo FROM s WHERE i = 50),
r AS (SELECT CASE WHEN top - low <= ln(4.0) THEN 0.0 ELSE 1 - ln(4.0 * (1 + 1e-12)) / (top - low) END AS least,
    ln(list_sum(list_transform(ls, lambda x: exp(x - top)))) - list_sum(list_transform(ls, lambda x: exp(x - top) * (x - top))) / list_sum(list_transform(ls, lambda x: exp(x - top))) >= goal AS flat FROM a),
e AS (SELECT greatest(CASE WHEN flat THEN 1.0 ELSE lo END, least) AS exponent FROM r, RECURSIVE_ENTROPY),
n AS (SELECT exponent, list_sum(list_transform(ls, lambda x: exp(exponent * (x - top)))) AS norm, top FROM e, a),
w AS (SELECT source, size, greatest(1, CAST(round(1000000 * exp(exponent * (l - top)) / norm) AS BIGINT)) AS parts FROM t, n),
b AS (SELECT *, CAST(max(ceil(size * 1000000 / parts)) OVER () AS BIGINT) AS budget FROM w),
q AS (SELECT *, greatest(size, budget * parts // 1000000) AS quota FROM b),
o AS (SELECT *, CAST(coalesce(sum(tokens) OVER (PARTITION BY source ORDER BY key, doc_id, tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM k),
u AS (SELECT o.*, size, parts, budget, quota, unnest(range(greatest((quota - before + size - 1) // size, 1))) AS epoch FROM o JOIN q ON o.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, source, tokens, epoch, before + epoch * size AS stream_at,
  (before + epoch * size) // greatest(1, 1048576 * parts // 1000000) AS block,
  row_number() OVER (PARTITION BY (before + epoch * size) // greatest(1, 1048576 * parts // 1000000) ORDER BY md5(key || ':' || CAST(epoch AS VARCHAR)), before + epoch * size, source NULLS FIRST) - 1 AS slot, parts, budget, quota
FROM u
"""


def op6_token_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_table_report(_documents(spark, sf_dir), tokenizer_path(), 2)


def op7_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmer_report(_documents(spark, sf_dir))


def op8_kernel_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_report(_documents(spark, sf_dir))


def op9_token_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_attribution(_documents(spark, sf_dir), tokenizer_path())


def op10_robust_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(_documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_rendezvous_shards,
            op2_vector_packing,
            op3_simhash_components,
            op4_arc_to_warc,
            op5_temperature_mixture,
            op6_token_tables,
            op7_closed_syncmers,
            op8_kernel_language_id,
            op9_token_attribution,
            op10_robust_quality,
        )
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_arc_to_warc": OP4_SQL, "op5_temperature_mixture": OP5_SQL}
