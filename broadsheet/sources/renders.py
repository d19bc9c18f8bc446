"""Pages as pixels, through injected adapters: counting, rendering, recognising.

An adapter is a function of a file's path. None is built in; without one a page gives null, so that
every step falls back.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Resolution, and the parts of a page (left, top, right, bottom) that are recognised
# apart: the header of any page, the left column of one paper's front page, the right rail of another's.
DPI = 150
WINDOWS = {"header": (0.0, 0.0, 1.0, 0.18), "WSJ": (0.0, 0.0, 0.19, 0.94), "FT": (0.81, 0.0, 0.995, 1.0)}


def page_counts(files: DataFrame, readers: Sequence[Callable[[str], int]], path: str = "path") -> DataFrame:
    """files with page_count: of the first reader that gives a positive number; 0 where none does."""

    def count(p: str) -> int:
        for reader in readers:
            try:
                n = int(reader(p))
            except Exception:  # the next reader may do better
                continue
            if n > 0:
                return n
        return 0

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f.assign(page_count=[count(p) for p in f[path]])

    return files.mapInPandas(run, T.StructType([*files.schema.fields, T.StructField("page_count", T.LongType())]))


def pages_of(files: DataFrame, selected: Sequence[int] = ()) -> DataFrame:
    """A row for each page of files with page_count, or for those of the selected that there are."""
    pages = files.filter("page_count > 0").withColumn("page", F.explode(F.sequence(F.lit(1).cast("long"), F.col("page_count"))))
    return pages.filter(F.col("page").isin(*selected)) if selected else pages


def recognised(pages: DataFrame, read: Callable[[str, int, int, tuple[float, float, float, float]], str | None] | None = None, dpi: int = DPI, publication: str | None = None) -> DataFrame:
    """pages (path, page) with text, header_text and, on page 1 of a publication with a window of its own, module_text.

    read: text of a file's page at a resolution within a part of it.
    """
    window = WINDOWS.get(publication or "")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def one(p: str, n: int, part: tuple[float, float, float, float] | None) -> str | None:
            return read(p, int(n), dpi, part) if read and part else None

        for f in frames:
            at = list(zip(f["path"], f["page"], strict=True))
            texts = {"text": [one(p, n, (0.0, 0.0, 1.0, 1.0)) for p, n in at], "header_text": [one(p, n, WINDOWS["header"]) for p, n in at], "module_text": [one(p, n, window if n == 1 else None) for p, n in at]}
            yield f.assign(**{k: pd.Series(v, index=f.index, dtype=object) for k, v in texts.items()})

    return pages.mapInPandas(run, T.StructType([*pages.schema.fields, *[T.StructField(c, T.StringType()) for c in ("text", "header_text", "module_text")]]))


def rendered(pages: DataFrame, render: Callable[[str, int, int], bytes] | None = None, dpi: int = DPI) -> DataFrame:
    """pages (path, page) with image: the bytes of a page at a resolution."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            made = [render(p, int(n), dpi) if render else None for p, n in zip(f["path"], f["page"], strict=True)]
            yield f.assign(image=pd.Series(made, index=f.index, dtype=object))

    return pages.mapInPandas(run, T.StructType([*pages.schema.fields, T.StructField("image", T.BinaryType())]))
