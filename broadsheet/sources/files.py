"""Sources: file listings, page checkpoints, exported databases, ledgers and pre-extracted blocks."""

from __future__ import annotations

import json
import re
import tempfile
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCKS = "page int, page_width double, page_height double, id string, bbox array<double>, text string, max_font_size double, median_font_size double, bold boolean"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, else the warehouse.

    Only where all run in one process, as in tests, a temporary folder will do.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        return tempfile.mkdtemp(prefix="broadsheet-")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


def list_files(spark: SparkSession, folder: str, pattern: str = "*.pdf", recursive: bool = False, content: bool = False) -> DataFrame:
    """path, name, stem, size and mtime of files; with content also sha256 and whether the tail ends a PDF.

    Without content no file is opened.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower()).load(folder)
    name = F.regexp_extract("path", "([^/]*)$", 1)
    columns = ["path", name.alias("name"), F.regexp_replace(name, "\\.[^.]*$", "").alias("stem"), F.col("length").alias("size"), F.col("modificationTime").alias("mtime")]
    if content:
        columns += [F.sha2("content", 256).alias("sha256"), has_end(F.col("content")).alias("has_eof")]
    return files.select(*columns)


def has_end(content: Column) -> Column:
    """Whether the last 16 KiB hold the mark that ends a PDF."""
    tail = F.substring(content, F.greatest(F.lit(1), F.length(content) - 16384 + 1), F.lit(16384))
    return F.contains(tail, F.lit(b"%%EOF"))


def name_selector(name: Column, stem: Column, selectors: Sequence[str]) -> Column:
    """Whether a file is selected: comma-separated names, stems or globs, case aside; no selector selects all."""
    wanted = [s.strip().lower() for part in selectors for s in part.split(",") if s.strip()]
    if not wanted:
        return F.lit(True)
    out = F.lit(False)
    for s in wanted:
        pattern = "^" + "".join({"*": ".*", "?": "."}.get(c, re.escape(c)) for c in s) + "$"
        out = out | (F.lower(name) == s) | (F.lower(stem) == s) | F.lower(name).rlike(pattern)
    return out


def ready(size: Column, age_seconds: Column, has_eof: Column, least_size: int = 1024, settle_seconds: int = 20) -> Column:
    """Files large enough, left alone long enough and with an end."""
    return (size >= least_size) & (age_seconds >= settle_seconds) & has_eof


def page_selector(text: str) -> list[int]:
    """Pages of a selector such as 2,4-6; reversed bounds are swapped."""
    pages: set[int] = set()
    for part in filter(None, (p.strip() for p in text.split(","))):
        a, _, b = part.partition("-")
        low, high = sorted((int(a), int(b or a)))
        pages.update(range(low, high + 1))
    return sorted(pages)


def pages_of_selector(text: Column) -> Column:
    """page_selector for a column: distinct pages in ascending order."""

    def span(part: Column) -> Column:
        a = F.trim(F.substring_index(part, "-", 1)).try_cast("int")
        b = F.trim(F.substring_index(part, "-", -1)).try_cast("int")
        return F.sequence(F.least(a, b), F.greatest(a, b))

    return F.array_sort(F.array_distinct(F.flatten(F.transform(F.filter(F.split(text, ","), lambda p: F.trim(p) != ""), span))))


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Pre-extracted pages, one JSON document a file, as one row for each valid block."""
    pages = spark.read.schema("page int, page_width double, page_height double, blocks array<struct<id string, bbox array<double>, text string, max_font_size double, median_font_size double, bold boolean>>").option("multiLine", True).json(path)
    rows = pages.select("page", "page_width", "page_height", F.posexplode("blocks").alias("n", "b"))
    valid = (F.size("b.bbox") >= 4) & (F.trim("b.text") != "")
    return rows.filter(valid).select("page", "page_width", "page_height", F.coalesce("b.id", F.format_string("b%03d", F.col("n") + 1)).alias("id"), *[F.col("b.bbox")[i].alias(c) for i, c in enumerate(("x0", "y0", "x1", "y1"))], "b.text", "b.max_font_size", "b.median_font_size", "b.bold")


def read_checkpoints(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Page checkpoints as JSON files; one that doesn't parse is a row of nulls with _corrupt set."""
    return spark.read.schema(schema + ", _corrupt string").option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)


def wrapped_json(text: Column) -> Column:
    """The JSON of a script that assigns one object or list; null where there is none."""
    found = F.regexp_extract(text, "(?s)=[ \\t-\\r]*([\\[{].*[\\]}])[ \\t-\\r]*;?[ \\t-\\r]*$", 1)
    return F.nullif(found, F.lit(""))


def read_wrapped(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Script-wrapped JSON databases: path, the type and date folders, and data parsed by a DDL schema."""
    files = spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value"))
    parts = F.reverse(F.split("path", "/"))
    return files.select("path", F.get(parts, F.lit(2)).alias("publication_type"), F.get(parts, F.lit(1)).alias("publication_date"), F.from_json(wrapped_json(F.col("value")), schema).alias("data"))


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object of names as (category, name, position); nothing where it is missing or broken."""
    empty = spark.createDataFrame([], "category string, name string, position long")
    try:
        text = "\n".join(r["value"] for r in spark.read.option("wholetext", True).text(path).limit(1).collect())
        found = json.loads(text)
    except Exception as e:  # a missing path is an AnalysisException, broken JSON a ValueError
        if isinstance(e, ValueError) or "PATH_NOT_FOUND" in str(e):
            return empty
        raise
    rows = [(k, v, i) for i, (k, v) in enumerate(found.items())] if isinstance(found, dict) else []
    return spark.createDataFrame(rows, empty.schema)


@dataclass(frozen=True)
class WatchConfig:
    """Settings of the polling source, checked when made."""

    input_dir: str
    pattern: str = "*.pdf"
    selection_mode: str = "latest"
    content_mode: str = "original"
    poll_seconds: int = 10800
    settle_seconds: int = 20
    min_bytes: int = 1024

    def __post_init__(self) -> None:
        if not self.input_dir:
            raise ValueError("input_dir is required")
        if self.selection_mode not in ("latest", "all_unprocessed"):
            raise ValueError(f"unknown selection_mode {self.selection_mode!r}")
        if self.content_mode not in ("original", "translated"):
            raise ValueError(f"unknown content_mode {self.content_mode!r}")
        if self.poll_seconds < 5:
            object.__setattr__(self, "poll_seconds", 5)

    @classmethod
    def load(cls, path: str) -> WatchConfig:
        with open(path, encoding="utf-8") as f:
            given = json.load(f)
        return cls(**{k: v for k, v in given.items() if k in cls.__dataclass_fields__})
