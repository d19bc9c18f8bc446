"""The report's anchors against a separate implementation in NumPy and hashlib."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from broadsheet.llm import queries as Q
from broadsheet.llm import syncmers as Y


def h64(data: bytes) -> int:
    """Spark's xxhash64 of bytes, seed 42, as a signed number."""
    return int(np.array([xxhash.xxh64_intdigest(data, 42)], np.uint64).view(np.int64)[0])


def brute(text, k=Y.LONG_K, s=Y.LONG_S):
    code = text.encode("utf-32-be", "surrogatepass")
    n = len(text)
    if n < k:
        return [(0, h64(code) >> 32)] if n else []
    inner = [h64(code[4 * i : 4 * (i + s)]) for i in range(n - s + 1)]
    out = []
    for i in range(n - k + 1):
        own = inner[i : i + k - s + 1]
        if min(own) in (own[0], own[-1]):
            out.append((i, h64(code[4 * i : 4 * (i + k)]) >> 32))
    return out


def digest(anchors):
    return hashlib.sha256(",".join(str(h) for _, h in anchors).encode()).hexdigest()


def likeness(a, b):
    one, two = Counter(h for _, h in a), Counter(h for _, h in b)
    both = sum((one & two).values())
    return both / (len(a) + len(b) - both) if a or b else 1.0


def found(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", Y.syncmers(F.col("t")).alias("a")).orderBy("i").collect()
    return [[(x["at"], x["h"]) for x in r["a"]] for r in rows]


def test_syncmers_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(Y, "BLOCK", 64)
    texts = ["", "a", "a" * 23, "a" * 24, "a" * 70, "aab" * 100, "語" * 30 + "日本🙂\n" * 50, " ".join(f"w{i * i % 97}" for i in range(300)), "\t\r\n " * 40]
    assert found(spark, texts) == [brute(t) for t in texts]


def test_every_row_of_the_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    got = {r["doc_id"]: r for r in Q.op7_closed_syncmers(spark, sf).collect()}
    anchors = [brute(t) for _, t in rows]
    for i, (doc, text) in enumerate(rows):
        j = (i + 1) % len(rows)
        q = len(text) // 4
        edited = brute(text[: len(text) - q] + rows[j][1][:q])
        r = got[doc]
        assert [(x["at"], x["h"]) for x in r["anchors"]] == anchors[i]
        assert r["fingerprint"] == digest(anchors[i]) and r["edited_fingerprint"] == digest(edited)
        assert r["near_edited"] == pytest.approx(likeness(anchors[i], edited)) and r["near_next"] == pytest.approx(likeness(anchors[i], anchors[j]))


@pytest.mark.parametrize("kind", ["cjk", "code", "spaced"])
def test_one_character_more_or_less_keeps_nearly_all_anchors(spark, kind):
    rng = np.random.default_rng(3)
    if kind == "cjk":
        text = "".join(map(chr, rng.integers(0x4E00, 0x9FA5, 4000)))
    elif kind == "code":
        text = "".join(map(chr, rng.integers(0x21, 0x7E, 4000)))
    else:
        text = " ".join("".join(map(chr, rng.integers(97, 123, 5))) for _ in range(700))
    own, *others = found(spark, [text, text[1:], "x" + text, text[:2000] + text[2001:], text[:2000] + "y" + text[2000:]])
    assert all(likeness(own, b) > 0.9 for b in others)


def test_gaps_are_bounded(spark):
    rng = np.random.default_rng(5)
    (a,) = found(spark, ["".join(map(chr, rng.integers(97, 123, 20000)))])
    at = [p for p, _ in a]
    assert max(y - x for x, y in zip(at, at[1:], strict=False)) <= Y.LONG_K - Y.LONG_S
