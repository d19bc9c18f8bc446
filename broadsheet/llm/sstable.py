"""Sorted-string-table shards of token ids.

A file holds sections, one after another: data blocks, a block index, a Bloom filter and a footer. A
section is a tag (D, I, B or F), a mask, its bytes xor the mask, MARK and a line feed. The mask is the
least that keeps MARK out, nearly always 0. So a file can be cut at MARK: Spark's text source reads
sections as rows, from any part of a file and any file system it knows, and its text sink, which closes
each row with a line feed, writes them. No task reads or holds a whole file.

data block    entries (varint shared, varint unshared, varint value length, key rest, value), then
              restart offsets as u32, their number as u32, and the tail: u64 entries and u64 ids in the
              file before, u32 crc32 of all before it. Keys drop the prefix that they share with the
              key before; every 16th key is whole, and its offset is a restart.
index         for each block: varint key length, last key, u64 offset of the block's tag, u32 its length.
Bloom filter  bits, then number of hashes as u8.
footer        u64 index offset, u32 index length, u64 filter offset, u32 filter length,
              u64 entries, u64 ids, magic ``BSSTABLE``.

A key is an identifier as 8 bytes, big end first, sign bit flipped, so that byte order is number
order; a null identifier is the empty key and comes first. A value is a document's ids as
little-endian unsigned 32-bit integers.
"""

from __future__ import annotations

import bisect
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from broadsheet.llm.common import cut, shared_path, text_slices
from broadsheet.llm.tokens import encoder

MAGIC = b"BSSTABLE"
FOOTER = struct.Struct("<QIQIQQ8s")
#: Ends a section. No part of it but the whole is both its beginning and its end.
MARK = b"\x01end-of-section"
#: Entries before, ids before, checksum.
TAIL = struct.Struct("<QQI")
RESTART_EVERY = 16


def key_of(doc_id: int | None) -> bytes:
    return b"" if doc_id is None else struct.pack(">Q", (doc_id + (1 << 63)) & ((1 << 64) - 1))


def id_of(key: bytes) -> int | None:
    return struct.unpack(">Q", key)[0] - (1 << 63) if key else None


def pack_ids(ids: bytes) -> bytes:
    """A value from ids as little-endian unsigned 32-bit integers."""
    wide = np.frombuffer(ids, "<u4")
    return b"\4" + ids if len(wide) and wide.max() >= 1 << 16 else b"\2" + wide.astype("<u2").tobytes()


def unpack_ids(value: bytes) -> bytes:
    return value[1:] if value[0] == 4 else np.frombuffer(value, "<u2", offset=1).astype("<u4").tobytes()


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        byte = data[at]
        at += 1
        n |= (byte & 127) << shift
        if byte < 128:
            return n, at
        shift += 7


def _bloom(keys: list[bytes], bits_per_key: int) -> bytes:
    hashes = max(1, round(bits_per_key * 0.69))
    size = max(64, len(keys) * bits_per_key + 7 & ~7)
    bits = np.zeros(size, np.uint8)
    if keys:
        h = np.array([xxhash.xxh64_intdigest(k) for k in keys], np.uint64)
        step = (h >> np.uint64(32)) | np.uint64(1)
        for i in range(hashes):
            bits[(h + np.uint64(i) * step) % np.uint64(size)] = 1
    return np.packbits(bits, bitorder="little").tobytes() + bytes([hashes])


def _section(tag: bytes, data: bytes) -> bytes:
    for mask in range(256):
        out = tag + bytes([mask]) + (data if not mask else bytes(np.frombuffer(data, np.uint8) ^ np.uint8(mask)))
        if MARK not in out + MARK[:-1]:
            return out + MARK
    raise AssertionError("some mask keeps MARK out of less than 256 times its own length of bytes")


def _bare(section: bytes | memoryview) -> bytes:
    """The bytes of a section without its mark."""
    mask = section[1]
    return bytes(np.frombuffer(section[2:], np.uint8) ^ np.uint8(mask)) if mask else bytes(section[2:])


def write_table(entries: Iterable[tuple[bytes, bytes]], block_bytes: int = 64 << 10, bits_per_key: int = 10) -> Iterator[bytes]:
    """The sections of a file for entries in ascending key order, each without its last line feed.

    Equal keys are kept in their order. Memory: one block, the index and the keys.
    """
    block, restarts, index, keys = bytearray(), [], [], []
    offset = count = ids = held = 0
    before = (0, 0)
    last = b""

    def close() -> bytes:
        nonlocal offset, held, before
        data = bytes(block) + np.array([*restarts, len(restarts)], "<u4").tobytes()
        data += TAIL.pack(*before, zlib.crc32(data))
        section = _section(b"D", data)
        index.append(_varint(len(last)) + last + struct.pack("<QI", offset, len(data) + 2))
        offset += len(section) + 1
        before = (count, ids)
        block.clear()
        restarts.clear()
        held = 0
        return section

    for key, value in entries:
        if key < last:
            raise ValueError("keys must ascend")
        if block and len(block) + len(value) > block_bytes:
            yield close()
        shared = 0
        if held % RESTART_EVERY:
            most = min(len(last), len(key))
            while shared < most and key[shared] == last[shared]:
                shared += 1
        else:
            restarts.append(len(block))
        block += _varint(shared) + _varint(len(key) - shared) + _varint(len(value)) + key[shared:] + value
        last = key
        held += 1
        count += 1
        ids += (len(value) - 1) // value[0]
        keys.append(key)
    if block:
        yield close()
    found, bloom = _section(b"I", b"".join(index)), _section(b"B", _bloom(keys, bits_per_key))
    yield found
    yield bloom
    yield _section(b"F", FOOTER.pack(offset, len(found) - len(MARK), offset + len(found) + 1, len(bloom) - len(MARK), count, ids, MAGIC))


class Block:
    """A data block from its section's bytes. Raises ValueError if they aren't what was written."""

    def __init__(self, section: bytes | memoryview):
        self.data = _bare(section)
        self.end = len(self.data) - TAIL.size
        if section[:1] != b"D" or self.end < 4:
            raise ValueError("not a data block")
        self.entries_before, self.ids_before, crc = TAIL.unpack_from(self.data, self.end)
        if zlib.crc32(memoryview(self.data)[: self.end]) != crc:
            raise ValueError("a data block is damaged")
        (self.n,) = struct.unpack_from("<I", self.data, self.end - 4)

    def entries(self, at: int = 0) -> Iterator[tuple[bytes, bytes]]:
        data, end, key = self.data, self.end - 4 - 4 * self.n, b""
        while at < end:
            shared, at = _read_varint(data, at)
            rest, at = _read_varint(data, at)
            length, at = _read_varint(data, at)
            key = key[:shared] + data[at : at + rest]
            at += rest
            yield key, data[at : at + length]
            at += length

    def from_key(self, key: bytes) -> Iterator[tuple[bytes, bytes]]:
        """Entries from the last restart before a key on, by binary search."""
        restarts = struct.unpack_from(f"<{self.n}I", self.data, self.end - 4 - 4 * self.n)
        low = max(0, bisect.bisect_left(restarts, key, key=lambda at: next(self.entries(at))[0]) - 1)
        return self.entries(restarts[low] if restarts else 0)


class Bloom:
    """A filter from its section's bytes."""

    def __init__(self, section: bytes | memoryview):
        self.bits = _bare(section)

    def may_hold(self, key: bytes) -> bool:
        h, size = xxhash.xxh64_intdigest(key), 8 * (len(self.bits) - 1)
        step = h >> 32 | 1
        return all(self.bits[b >> 3] >> (b & 7) & 1 for b in ((h + i * step & (1 << 64) - 1) % size for i in range(self.bits[-1])))


class Table:
    """Looks up keys in one file's bytes."""

    def __init__(self, data: bytes):
        whole = len(data) >= FOOTER.size + len(MARK) + 3 and data.endswith(MARK + b"\n")
        foot = data[-FOOTER.size - len(MARK) - 3 : -1 - len(MARK)] if whole else b""
        if foot[:1] != b"F":
            raise ValueError("not a whole file")
        at, n, bloom_at, bloom_n, self.count, self.ids, magic = FOOTER.unpack(_bare(foot))
        if magic != MAGIC:
            raise ValueError("not a file of this format")
        self.data = data
        self.bloom = Bloom(data[bloom_at : bloom_at + bloom_n])
        self.blocks: list[tuple[int, int]] = []
        self.last_keys: list[bytes] = []
        index = _bare(data[at : at + n])
        at = 0
        while at < len(index):
            size, at = _read_varint(index, at)
            self.last_keys.append(index[at : at + size])
            self.blocks.append(struct.unpack_from("<QI", index, at + size))
            at += size + 12

    def block(self, i: int) -> Block:
        offset, size = self.blocks[i]
        return Block(self.data[offset : offset + size])

    def __iter__(self) -> Iterator[tuple[bytes, bytes]]:
        for i in range(len(self.blocks)):
            yield from self.block(i).entries()

    def may_hold(self, key: bytes) -> bool:
        return self.bloom.may_hold(key)

    def get(self, key: bytes) -> list[bytes]:
        """Values of a key: filter, then binary search in the index and in a block's restarts."""
        if not self.may_hold(key):
            return []
        found = []
        for i in range(bisect.bisect_left(self.last_keys, key), len(self.blocks)):
            for k, value in self.block(i).from_key(key):
                if k > key:
                    return found
                if k == key:
                    found.append(value)
        return found


def write_token_tables(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", file_bytes: int = 128 << 20) -> None:
    """Encodes every whole text (null: empty), appends end_id and writes files in ascending id order.

    The rows are dealt out by ranges of (id, hash of the text, row), so neither a repeated id nor a
    repeated row makes a large file; a file holds about file_bytes of text, or one longer text. Ids
    must be integers; null ones come first. Other columns are not read. An empty table makes files
    without entries or none.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    dealt = rows.withColumn("h", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    ranges = dealt.repartitionByRange(max(1, -(-total // file_bytes)), F.col("key").asc_nulls_first(), "h", "row")
    ranges = ranges.sortWithinPartitions(F.col("key").asc_nulls_first(), "h", "row").select("key", "text")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer_path), np.array([end_id], "<u4").tobytes()

        def entries():
            for batch, texts in text_slices(batches):
                for key, ids in zip(batch.column(0).to_pylist(), encode.ids(texts), strict=True):
                    yield key_of(key), pack_ids(ids + end)

        for section in write_table(entries()):
            yield pa.record_batch([pa.array([section], pa.binary())], names=["section"])

    sections = ranges.mapInArrow(build, "section binary")
    sections.select(F.col("section").cast("string").alias("value")).write.option("lineSep", "\n").text(path)


def _sections(spark: SparkSession, path: str) -> DataFrame:
    """(file, section) of the files' sections, without their marks."""
    rows = spark.read.option("lineSep", (MARK + b"\n").decode()).text(path)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("section"))


def read_token_tables(spark: SparkSession, path: str) -> DataFrame:
    """A row for each document of the files: key, ids_before (in its file), n_tokens, ids_crc32, file and place."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                section = batch.column(1)[i].as_buffer()
                if section is None or bytes(memoryview(section)[:1]) != b"D":
                    continue
                block = Block(memoryview(section))
                keys, counts, crcs = [], [], []
                for key, value in block.entries():
                    ids = unpack_ids(value)
                    keys.append(id_of(key))
                    counts.append(len(ids) // 4)
                    crcs.append(zlib.crc32(ids))
                n = len(keys)
                before = block.ids_before + np.cumsum([0, *counts])[:-1]
                yield pa.record_batch([pa.array([batch.column(0)[i].as_py()] * n, pa.string()), pa.array(range(block.entries_before, block.entries_before + n), pa.int64()), pa.array(keys, pa.int64()), pa.array(before, pa.int64()), pa.array(counts, pa.int64()), pa.array(crcs, pa.int64())], names=["file", "place", "key", "ids_before", "n_tokens", "ids_crc32"])

    return _sections(spark, path).mapInArrow(read, "file string, place long, key long, ids_before long, n_tokens long, ids_crc32 long")


def look_up(spark: SparkSession, path: str, ids: list[int | None]) -> DataFrame:
    """(key, value) of the documents with these identifiers: ids as little-endian unsigned 32-bit integers.

    Files whose Bloom filter holds none of them are not read again; in a block binary search finds the
    restart to begin at. The identifiers are a list that fits the driver, the files needn't.
    """
    wanted = sorted({key_of(x) for x in ids})

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = [name.as_py() for name, x in zip(batch.column(0), batch.column(1), strict=True) if x.as_py()[:1] == b"B" and any(map(Bloom(x.as_py()).may_hold, wanted))]
            yield pa.record_batch([pa.array(hit, pa.string())], names=["file"])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, values = [], []
            for x in batch.column(1):
                if x.as_py()[:1] != b"D":
                    continue
                block = Block(x.as_py())
                first = next(block.entries())[0]
                for key in wanted[max(0, bisect.bisect_left(wanted, first)) :]:
                    hits = [v for k, v in _until(block.from_key(key), key) if k == key]
                    keys += [id_of(key)] * len(hits)
                    values += map(unpack_ids, hits)
            yield pa.record_batch([pa.array(keys, pa.int64()), pa.array(values, pa.binary())], names=["key", "value"])

    files = [r["file"] for r in _sections(spark, path).mapInArrow(candidates, "file string").distinct().collect()]
    if not files:
        return spark.createDataFrame([], "key long, value binary")
    return _sections(spark, files).mapInArrow(found, "key long, value binary")


def _until(entries: Iterator[tuple[bytes, bytes]], key: bytes) -> Iterator[tuple[bytes, bytes]]:
    for k, v in entries:
        if k > key:
            return
        yield k, v


def token_table_report(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Writes the files and reports each document as read back from them.

    start counts the ids of all documents before it in ascending (doc_id, file, place) order; null
    doc_ids come first.
    """
    spark = docs.sparkSession
    path = shared_path(spark, "token-tables")
    write_token_tables(docs, path, tokenizer_path, end_id)
    rows = cut(read_token_tables(spark, path))
    files = rows.groupBy("file").agg(F.min(F.struct(F.coalesce(F.col("key"), F.lit(-(1 << 63))), "file")).alias("first"), F.sum("n_tokens").alias("ids"))
    # A row per file: the only place where all files meet.
    before = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    bases = files.select("file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    out = rows.join(bases, "file")
    return out.select(F.col("key").alias("doc_id"), (F.col("base") + F.col("ids_before")).alias("start"), "n_tokens", "ids_crc32")
