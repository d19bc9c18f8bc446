"""Vector bin packing of token pieces into training sequences.

Dot-product heuristic: a sequence is filled by taking, again and again, that piece which still fits
under all limits and whose demand has the largest inner product with what the sequence has left.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.llm.common import text_slices, wrapped
from broadsheet.llm.tokens import encoder

#: Pieces to choose from; new ones come in whenever a sequence is closed.
POOL = 1024
#: Words that a worker's encoder keeps here, some 200 bytes each; nothing else in these stages is large.
WORDS_KEPT = 1_500_000


def token_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, limit: int, id_col: str = "doc_id", text_col: str = "text", forget: bool = False) -> DataFrame:
    """The ids of every whole text (null: empty) and then end_id, cut into pieces of at most ``limit``.

    Every document, an empty one too, has a piece. Repeated rows and null ids are rows like others.
    forget: a worker drops the encoder's cache after each task, where other stages share its memory.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer_path, WORDS_KEPT), np.array([end_id], "<u4").tobytes()
        for batch, texts in text_slices(batches, max_bytes=2 << 20):
            owner, start, length, crc, total = [], [], [], [], []
            for i, ids in enumerate(encode.ids(texts)):
                data = ids + end
                for at in range(0, len(data), 4 * limit):
                    piece = data[at : at + 4 * limit]
                    owner.append(i)
                    start.append(at // 4)
                    length.append(len(piece) // 4)
                    crc.append(zlib.crc32(piece))
                    total.append(len(data) // 4)
            longs = [pa.array(x, pa.int64()) for x in (start, length, crc, total)]
            yield pa.record_batch([batch.column(0).take(pa.array(owner, pa.int64())), *longs], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        if forget:
            encode.forget()

    return rows.mapInArrow(pieces, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long")


class _Pool:
    """Pieces to choose from, as a matrix of shares of the limits."""

    def __init__(self, width: int):
        self.rows = np.zeros(0, np.int64)
        self.need = np.zeros((0, width))

    def add(self, rows: np.ndarray, need: np.ndarray) -> None:
        self.rows = np.concatenate([self.rows, rows])
        self.need = np.concatenate([self.need, need])

    def fill(self) -> list[int]:
        """Takes the pieces of one sequence, in the order chosen."""
        left, need = np.ones(self.need.shape[1]), self.need
        weight = need.mean(axis=0) + 1e-9  # what is scarce in the pool counts more
        open_ = np.arange(len(need))
        taken: list[int] = []
        while len(open_):
            open_ = open_[(need[open_] <= left + 1e-12).all(axis=1)]
            if not len(open_):
                break
            best = open_[int(np.argmax(need[open_] @ (weight * left)))]
            taken.append(int(best))
            left = left - need[best]
            open_ = open_[open_ != best]
        rows = self.rows[taken].tolist()
        keep = np.ones(len(need), bool)
        keep[taken] = False
        self.rows, self.need = self.rows[keep], need[keep]
        return rows


def pack(pieces: DataFrame, limits: Mapping[str, int], length: str, partitions: int | None = None) -> DataFrame:
    """pieces with sequence_id and offset; in no sequence the sum of a column exceeds its limit.

    limits: for each numeric column its limit (null counts as 0; a row beyond a limit gets a sequence
    of its own). ``length`` is the column whose sum is the offset. Rows are dealt out by a hash of
    all their columns, sorted by it and packed as they come: a task keeps a pool of some thousand
    rows, whatever it reads, and gives the same sequences when it runs again. Only rows that are
    equal in every column share a hash. Columns named sequence_id or offset are replaced.
    """
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    n = partitions or int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = [F.col(f"`{c}`") for c in names]
    # Equal rows are dealt out too: where they came from is part of the deal, not of the order.
    rows = wrapped(pieces.select(*own), h=F.xxhash64(*own), salt=F.monotonically_increasing_id() % 64)
    dealt = rows.repartition(n, "h", "salt").sortWithinPartitions("h", "doc").select("doc.*")
    schema = T.StructType([*(pieces.schema[c] for c in names), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    columns, caps, offset_at = list(limits), np.array([limits[c] for c in limits], float), names.index(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sequence = TaskContext.get().partitionId() << 40
        pool, lengths = _Pool(len(columns)), {}
        store: pa.Table | None = None  # rows that wait, then those that just came
        out: list[tuple[int, int, int]] = []

        def place(rows: list[int]) -> None:
            nonlocal sequence
            at = 0
            for r in rows:
                out.append((r, sequence, at))
                at += lengths.pop(r)
            sequence += 1

        for batch in batches:
            for begin in range(0, batch.num_rows, POOL):
                part = batch.slice(begin, POOL).select(names)
                table = pa.Table.from_batches([part])
                if store is not None:
                    # pool rows are renumbered to their place in the store
                    order = pool.rows.tolist()
                    lengths = {i: lengths[r] for i, r in enumerate(order)}
                    store = pa.concat_tables([store.take(pa.array(order, pa.int64())), table]).combine_chunks()
                    pool.rows = np.arange(len(order))
                    fresh = len(order)
                else:
                    store, fresh = table, 0
                need = np.column_stack([np.nan_to_num(part.column(names.index(c)).to_numpy(zero_copy_only=False).astype(float)) for c in columns]) / caps
                for i, x in enumerate(part.column(offset_at).to_pylist()):
                    lengths[fresh + i] = int(x or 0)
                rows = np.arange(fresh, fresh + part.num_rows)
                whole = (need >= 1).any(axis=1)
                for r in rows[whole].tolist():
                    place([r])
                pool.add(rows[~whole], need[~whole])
                while len(pool.rows) > POOL:
                    place(pool.fill())
                yield from _flush(store, out)
                out = []
        while len(pool.rows):
            place(pool.fill())
        if store is not None:
            yield from _flush(store, out)

    def _flush(store: pa.Table, out: list[tuple[int, int, int]]) -> Iterator[pa.RecordBatch]:
        if out:
            at, seq, off = zip(*out, strict=True)
            part = store.take(pa.array(at, pa.int64()))
            part = part.append_column("sequence_id", pa.array(seq, pa.int64())).append_column("offset", pa.array(off, pa.int64()))
            yield from part.combine_chunks().to_batches()

    return dealt.mapInArrow(run, schema)
