"""Token counts by field: each document is encoded once, as a whole, and its tokens are shared out.

Tokens carry the span of characters they come from. Spans and sections are joined by interval; a
token that crosses a border goes by a named rule.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import text_slices
from broadsheet.llm.tokens import encoder

#: first: to the section where a token begins; last: where it ends; most: where it has most of its
#: characters, the earlier one on a tie.
RULES = ("first", "last", "most")


def allocate(first: np.ndarray, last: np.ndarray, borders: np.ndarray, rule: str = "most") -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and how many of them cross a border.

    first, last: spans of the tokens, not empty; borders: where sections begin, ascending from 0,
    then the end of the text. Sections may be empty and then get nothing.
    """
    n = len(borders) - 1
    a = np.searchsorted(borders, first, side="right") - 1
    b = np.searchsorted(borders, last - 1, side="right") - 1
    crosses = a != b
    if rule == "first":
        owner = a
    elif rule == "last":
        owner = b
    elif rule == "most":
        owner = a.copy()
        for i in np.flatnonzero(crosses).tolist():
            own = np.minimum(borders[a[i] + 1 : b[i] + 2], last[i]) - np.maximum(borders[a[i] : b[i] + 1], first[i])
            owner[i] = a[i] + int(np.argmax(own))
    else:
        raise ValueError(f"rule must be one of {RULES}")
    return np.bincount(owner, minlength=n), np.bincount(owner[crosses], minlength=n)


def token_attribution(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", rule: str = "most") -> DataFrame:
    """A row for each line of each text: its characters, tokens and tokens that cross its borders.

    Sections are lines with the line feed that ends them; a text that ends in one has no empty line
    after it. field: title for a text's first line, body for others. Over a document, tokens add up
    to those of the whole text, encoded once. A null or empty text has one section of zero
    characters. Repeated rows and null ids are rows like others. No shuffle.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    rows = docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias("_text"))
    kind = rows.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path)
        for batch, texts in text_slices(batches, "_text", 1 << 20):
            owner, begins, sizes, tokens, crossing, section, whole = [], [], [], [], [], [], []
            for i, (text, ids) in enumerate(zip(texts, encode.ids(texts), strict=True)):
                lines = text.split("\n")
                lengths = [len(x) + 1 for x in lines]
                lengths[-1] -= 1
                if len(lengths) > 1 and not lengths[-1]:
                    lengths.pop()
                borders = np.cumsum([0, *lengths])
                count, across = allocate(*encode.spans_of(text, ids), borders, rule)
                n = len(lengths)
                owner.append(np.full(n, i))
                section.append(np.arange(n))
                begins.append(borders[:-1])
                sizes.append(np.array(lengths))
                tokens.append(count)
                crossing.append(across)
                whole.append(np.full(n, len(ids) // 4))
            cat = lambda x: pa.array(np.concatenate(x).astype(np.int64))
            yield pa.record_batch([batch.column(0).take(cat(owner)), *map(cat, (section, begins, sizes, tokens, crossing, whole))], names=[id_col, "section", "start_char", "n_chars", "n_tokens", "crossing_tokens", "doc_tokens"])

    out = rows.mapInArrow(run, f"`{id_col}` {kind}, section long, start_char long, n_chars long, n_tokens long, crossing_tokens long, doc_tokens long")
    return out.withColumn("field", F.when(F.col("section") == 0, "title").otherwise("body"))
