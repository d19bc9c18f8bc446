"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute needs it
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from broadsheet.sources.files import shared_folder

#: Texts that a function of texts sees at once.
TEXTS_AT_ONCE = 256
#: Rows of one Arrow batch handed on by a Python stage.
OUT_ROWS = 8192
#: Files of a table of few rows, and rows of numbers that one more file is for.
FEW_FILES = 8
FILE_ROWS = 8192


def wrapped(docs: DataFrame, **more: Column) -> DataFrame:
    """A row's own columns as one struct, doc, beside others: so names of theirs clash with none of docs'.

    select("doc.*") gives the row back.
    """
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(own.alias("doc"), *[c.alias(k) for k, c in more.items()])


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share; checkpoints go there too."""
    root = shared_folder(spark)
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def files_for(rows: int) -> int:
    """Files of a table of at most so many rows of numbers."""
    return max(FEW_FILES, -(-rows // FILE_ROWS))


def cut(df: DataFrame, files: int | None = None) -> DataFrame:
    """The same rows read from reliable storage, with lineage cut there.

    Later stages neither recompute what stands above nor depend on an executor's disk.

    files: of a small table, so that it isn't as many files as a shuffle has partitions, empty ones too.
    Without Hadoop's native library an executor runs chmod twice for each file, and until that
    process has begun it counts with all of the executor's memory.
    """
    spark = df.sparkSession
    root = shared_root(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    if files and files < int(spark.conf.get("spark.sql.shuffle.partitions")):
        df = df.repartition(files)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str, compression: str = "none", files: int | None = None) -> DataFrame:
    """Like cut(), as a Parquet table: columnar, for wide rows and small tables.

    files: of a small table, so that it isn't as many files as a shuffle has partitions.

    Tables of numbers are written as they are: each file's codec would hold memory outside the heap
    until a collection, and many small files come between two of those.
    """
    path = shared_path(df.sparkSession, name)
    (df.repartition(files) if files else df).write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, rows: int = 2000) -> SparkSession:
    """The session, with Arrow batches of at most so many rows: the default of 10,000 whole texts is tens of MB in the JVM and in each worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))
    return spark


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text", max_bytes: int = 8 << 20) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches of bounded text size, each with its texts; a null text counts as empty.

    A single text longer than max_bytes makes a slice of its own.
    """
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        lengths = [x or 0 for x in pa.compute.binary_length(texts).to_pylist()]
        begin = size = 0
        for i, n in enumerate(lengths):
            if i > begin and size + n > max_bytes:
                yield batch.slice(begin, i - begin), [x or "" for x in texts.slice(begin, i - begin).to_pylist()]
                begin, size = i, 0
            size += n
        if len(lengths) > begin:
            yield batch.slice(begin), [x or "" for x in texts.slice(begin).to_pylist()]


def of_texts(kind: str, of: Callable[[list[str | None]], pa.Array], once: bool = False) -> Callable[[Column], Column]:
    """A column function from a function of some texts, which gives an array of this kind.

    A batch of rows stays in Arrow; only a slice of it is Python strings at a time.

    once: a filter on the column isn't moved below it, which would work the column out for the filter
    and again for what is kept, each in a worker of its own.
    """

    @arrow_udf(kind)
    def run(texts: pa.Array) -> pa.Array:
        parts = [of([x if isinstance(x, str) else None for x in texts.slice(i, TEXTS_AT_ONCE).to_pylist()]) for i in range(0, max(len(texts), 1), TEXTS_AT_ONCE)]
        return pa.concat_arrays(parts)

    return run.asNondeterministic() if once else run


def structs(**columns: pa.Array) -> pa.StructArray:
    return pa.StructArray.from_arrays(list(columns.values()), list(columns))
