"""From raw documents to packed training sequences: quality, language, near copies, mixture, packing.

A stage takes (spark, docs, sf_dir) and returns a table; each is written as Parquet and read again as
the next one's docs. All but the last keep the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.llm.common import bounded_batches, shared_root, wrapped
from broadsheet.llm.langid import decided, train
from broadsheet.llm.mixing import mix
from broadsheet.llm.packing import pack, token_pieces
from broadsheet.llm.quality import quality_filter
from broadsheet.llm.queries import SEQUENCE, WORD, tokenizer_path
from broadsheet.llm.simhash import simhash_dedup

#: Of a language's decision value, which is 1 for its own texts and -1 for others in the fit.
LEAST_DECISION = 0.1


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what fails the base limits or lies outside its language's and source's cloud."""
    bounded_batches(spark)
    return quality_filter(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts in no language that was learned: those without a letter, or whose decision values are all near or below zero."""
    bounded_batches(spark)
    marked = wrapped(docs, d=decided(docs, train(docs), F.col("text")))
    return marked.filter(F.col("d") >= LEAST_DECISION).select("doc.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: five-word shingles, a similarity of 0.8 or more."""
    bounded_batches(spark)
    return simhash_dedup(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents of small sources until the sources' entropy is 0.98 of the most, or twice at most; loses none."""
    return mix(docs, F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)), target_entropy=0.98, repetition_limit=2.0)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences."""
    bounded_batches(spark)
    pieces = token_pieces(docs, tokenizer_path(), 1, SEQUENCE, forget=True)
    pieces = pieces.withColumn("segments", F.lit(1)).withColumn("loss_tokens", F.col("length") - (F.col("start") == 0).cast("long"))
    return pack(pieces, {"length": SEQUENCE, "segments": 128, "loss_tokens": SEQUENCE}, "length").drop("segments")


STAGES = [("quality", quality), ("language", language), ("near_copies", near_copies), ("mixing", mixing), ("packing", packing)]

#: SQL has neither the tokenizer nor the kernels; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{shared_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        out = f"{base}/{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
