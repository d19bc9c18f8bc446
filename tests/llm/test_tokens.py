import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from broadsheet.llm import queries as Q
from broadsheet.llm.attribution import allocate, token_attribution
from broadsheet.llm.packing import pack, token_pieces
from broadsheet.llm.sstable import Table, id_of, key_of, pack_ids, read_token_tables, unpack_ids, write_table, write_token_tables
from broadsheet.llm.tokens import Encoder, chunks
from tests.llm.helpers import documents, empty

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(Q.tokenizer_path())
    t.encode_special_tokens = True
    return t


SMALL = Encoder(Q.tokenizer_path(), entries=64)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(list("ab1.,'_-  \n\n\té日 　́\x00\x1c\x85​\U0001f642") + ["<|endoftext|>", "'s", " the", "\r\n"]), max_size=24).map("".join))
def test_cut_encoding_equals_whole_encoding(whole, text):
    assert "".join(chunks(text)) == text
    expected = whole.encode(text, add_special_tokens=False)
    ids = SMALL.ids([text])[0]
    assert np.frombuffer(ids, "<u4").tolist() == expected.ids
    first, last = SMALL.spans_of(text, ids)
    assert list(zip(first.tolist(), last.tolist(), strict=True)) == expected.offsets


def _ids(whole, text, end):
    return np.array([*whole.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def test_token_tables_hold_every_row(spark, whole):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = sorted(Q.op6_token_tables(spark, SF).collect(), key=lambda r: r["doc_id"])
    assert [r["doc_id"] for r in rows] == sorted(texts)
    start = 0
    for r in rows:
        ids = _ids(whole, texts[r["doc_id"]], 2)
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_token_tables_with_nulls_repeats_and_no_rows(spark, tmp_path):
    docs = documents(spark)
    path = f"file://{tmp_path}/t"
    write_token_tables(docs, path, Q.tokenizer_path(), 2, file_bytes=20_000)
    back = read_token_tables(spark, path)
    assert sorted(str(r["key"]) for r in back.collect()) == sorted(str(r["doc_id"]) for r in docs.collect())
    assert back.select("file").distinct().count() > 1
    write_token_tables(empty(spark), f"file://{tmp_path}/e", Q.tokenizer_path(), 2)
    assert read_token_tables(spark, f"file://{tmp_path}/e").count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(-(2**63), 2**63 - 1) | st.integers(-5, 400), st.binary(max_size=40)), max_size=120), st.sampled_from([1, 64, 10_000]))
def test_tables_look_up_what_they_hold(pairs, block):
    entries = sorted(((key_of(k), pack_ids(v[: len(v) // 4 * 4])) for k, v in pairs), key=lambda e: e[0])
    data = b"".join(s + b"\n" for s in write_table(entries, block_bytes=block))
    table = Table(data)
    assert list(table) == entries and table.count == len(entries)
    for k, _ in pairs:
        assert table.get(key_of(k)) == [v for e, v in entries if e == key_of(k)]
    assert table.get(key_of(-77)) == [v for e, v in entries if e == key_of(-77)]
    assert all(id_of(key_of(k)) == k for k, _ in pairs) and id_of(key_of(None)) is None


def test_broken_tables_are_refused():
    data = b"".join(s + b"\n" for s in write_table([(key_of(1), pack_ids(b"\1\0\0\0"))]))
    for bad in (data[:-1], b"", data[:-2] + b"x\n"):
        with pytest.raises(ValueError):
            Table(bad)
    with pytest.raises(ValueError):
        list(write_table([(b"b", b"\2"), (b"a", b"\2")]))
    wide = np.array([70_000, 1], "<u4").tobytes()
    assert unpack_ids(pack_ids(wide)) == wide and unpack_ids(pack_ids(b"")) == b""


def _check_packing(rows, limits, length="length"):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append(r)
    for group in by.values():
        group.sort(key=lambda r: r["offset"])
        at = 0
        for r in group:
            assert r["offset"] == at
            at += r[length]
        if len(group) > 1:
            assert all(sum(r[c] or 0 for r in group) <= m for c, m in limits.items())
    return by


def test_packing_query(spark, whole):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = Q.op2_vector_packing(spark, SF).collect()
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
    assert set(pieces) == set(texts)
    for doc, group in pieces.items():
        ids, at = _ids(whole, texts[doc], 1), 0
        for r in sorted(group, key=lambda r: r["start"]):
            part = ids[r["start"] : r["start"] + r["length"]]
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(part.tobytes()) and r["doc_tokens"] == len(ids)
            at += r["length"]
        assert at == len(ids)
    by = _check_packing(rows, {"length": 2048})
    used = sum(r["length"] for r in rows)
    assert used / (2048 * len(by)) > 0.9


def test_packing_limits_nulls_and_repeats(spark):
    rows = [(i % 7, 1, i % 3 if i % 5 else None, "x") for i in range(3000)] + [(50, 1, 0, "big")] + [(3, 1, 1, "same")] * 40
    df = spark.createDataFrame(rows, "length long, segments int, loss long, sequence_id string")
    limits = {"length": 20, "segments": 5, "loss": 6}
    out = pack(df, limits, "length", partitions=3)
    found = out.collect()
    assert len(found) == len(rows) and out.columns == ["length", "segments", "loss", "sequence_id", "offset"]
    _check_packing(found, limits)
    assert sorted((r["sequence_id"], r["offset"]) for r in found) == sorted((r["sequence_id"], r["offset"]) for r in pack(df, limits, "length", partitions=3).collect())
    assert pack(df.limit(0), limits, "length").count() == 0


def test_pieces_of_odd_documents(spark):
    docs = documents(spark)
    found = token_pieces(docs, Q.tokenizer_path(), 1, 100).collect()
    assert {r["doc_id"] for r in found} == {r["doc_id"] for r in docs.collect()}
    assert all(1 <= r["length"] <= 100 for r in found)
    assert sum(r["length"] for r in found if r["doc_id"] == 3) == 1  # null text: the end id alone
    assert token_pieces(empty(spark), Q.tokenizer_path(), 1, 100).count() == 0


def test_allocation_rules():
    first, last, borders = np.array([0, 2, 5, 8]), np.array([2, 5, 8, 10]), np.array([0, 4, 4, 6, 10])
    assert [x.tolist() for x in allocate(first, last, borders, "first")] == [[2, 0, 1, 1], [1, 0, 1, 0]]
    assert [x.tolist() for x in allocate(first, last, borders, "last")] == [[1, 0, 1, 2], [0, 0, 1, 1]]
    assert [x.tolist() for x in allocate(first, last, borders, "most")] == [[2, 0, 0, 2], [1, 0, 0, 1]]
    # a tie goes to the earlier section
    assert allocate(np.array([0]), np.array([4]), np.array([0, 2, 4]), "most")[0].tolist() == [1, 0]
    with pytest.raises(ValueError):
        allocate(first, last, borders, "other")


@pytest.mark.parametrize("rule", ["first", "last", "most"])
def test_attribution_against_the_library(spark, whole, rule):
    docs = documents(spark)
    found = {}
    for r in token_attribution(docs, Q.tokenizer_path(), rule=rule).collect():
        found.setdefault(str(r["doc_id"]), []).append(r)
    for doc in docs.collect():
        text = doc["text"] or ""
        lines = text.split("\n")
        sizes = [len(x) + 1 for x in lines[:-1]] + ([len(lines[-1])] if lines[-1] or len(lines) == 1 else [])
        begins = [sum(sizes[:i]) for i in range(len(sizes))]
        expected = [0] * len(sizes)
        for a, b in whole.encode(text, add_special_tokens=False).offsets:
            inside = [sum(1 for c in range(a, b) if s <= c < s + n) for s, n in zip(begins, sizes, strict=True)]
            hits = [i for i, k in enumerate(inside) if k]
            expected[{"first": hits[0], "last": hits[-1], "most": inside.index(max(inside))}[rule]] += 1
        rows = sorted(found[str(doc["doc_id"])], key=lambda r: r["section"])[: len(sizes)] if text else found[str(doc["doc_id"])]
        if sum(str(d["doc_id"]) == str(doc["doc_id"]) for d in docs.collect()) == 1:
            assert [r["n_tokens"] for r in rows] == expected
            assert [r["start_char"] for r in rows] == begins
    assert token_attribution(empty(spark), Q.tokenizer_path()).count() == 0
