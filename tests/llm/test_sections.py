"""Token tables cut at their sections, and archives of bounded size."""

import zlib

import numpy as np
import pytest

from broadsheet.llm import queries as Q
from broadsheet.llm import sstable as T
from broadsheet.llm import warc as W
from tests.llm.helpers import documents, words


def test_the_mark_never_stands_in_a_section():
    for data in (b"", T.MARK, T.MARK * 3, T.MARK[:-1], bytes(b ^ 1 for b in T.MARK) + T.MARK):
        section = T._section(b"D", data)
        assert section.count(T.MARK) == 1 and section.endswith(T.MARK) and T._bare(section[: -len(T.MARK)]) == data


def test_damaged_blocks_are_refused():
    section = next(T.write_table([(T.key_of(1), T.pack_ids(b"\1\0\0\0"))]))[: -len(T.MARK)]
    assert [k for k, _ in T.Block(section).entries()] == [T.key_of(1)]
    for bad in (section[:-1], section[:3] + b"\xff" + section[4:], b"I" + section[1:], b"D\0"):
        with pytest.raises(ValueError):
            T.Block(bad)


def test_a_file_of_many_blocks_is_read_by_parts_and_looked_up(spark, tmp_path, monkeypatch):
    import random

    rng = random.Random(1)
    docs = spark.createDataFrame([(i * 3, words(rng, "en", 2000)) for i in range(150)] + [(None, "x"), (7, "twice"), (7, "again")], "doc_id long, text string")
    path = f"file://{tmp_path}/t"
    T.write_token_tables(docs, path, Q.tokenizer_path(), 2)
    back = T.read_token_tables(spark, path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        assert back.rdd.getNumPartitions() > 3
        rows = sorted(T.read_token_tables(spark, path).collect(), key=lambda r: (r["file"], r["place"]))
        assert len(rows) == 153 and [r["place"] for r in rows if r["file"] == rows[0]["file"]] == list(range(sum(r["file"] == rows[0]["file"] for r in rows)))
        total = 0
        for r, after in zip(rows, [*rows[1:], None], strict=True):
            assert r["ids_before"] == total
            total = total + r["n_tokens"] if after is not None and after["file"] == r["file"] else 0
        got = T.look_up(spark, path, [0, 7, 8, 300, None]).collect()
        by = {(r["key"], r["ids_crc32"]) for r in rows if r["key"] in (0, 7, 300, None)}
        assert {(r["key"], zlib.crc32(bytes(r["value"]))) for r in got} == by and len(got) == 5
        assert T.look_up(spark, path, [8]).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_ids_that_spell_the_mark(spark):
    ids = np.frombuffer(T.MARK * 2, "<u2").astype("<u4").tobytes()
    entries = [(T.key_of(i), T.pack_ids(ids)) for i in range(5)]
    data = b"".join(s + b"\n" for s in T.write_table(entries))
    assert list(T.Table(data)) == entries and T.Table(data).get(T.key_of(3)) == [entries[3][1]]


def test_archives_hold_a_bounded_number_of_records(spark, tmp_path):
    pages = documents(spark, 120).selectExpr("doc_id as page_id", "source as url", "text as html").coalesce(1)
    W.write_archives(pages, f"file://{tmp_path}/w", records_per_file=20)
    files = list((tmp_path / "w").glob("part-*"))
    assert len(files) >= 6
    sizes = [sum(1 for _ in W.read_warc(zlib.decompress(f.read_bytes(), 31))) for f in files]
    assert max(sizes) <= 20 and W.read_archives(spark, f"file://{tmp_path}/w").count() == pages.count()
