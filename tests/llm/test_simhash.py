import random

import numpy as np
import pytest
import xxhash

from broadsheet.llm import queries as Q
from broadsheet.llm import simhash as S
from tests.llm.helpers import documents, empty, words


def brute_print(text, k=4, seed=42):
    import re

    found = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not found:
        return 0
    grams = [" ".join(found[i : i + k]) for i in range(len(found) - k + 1)] or [" ".join(found)]
    h = [xxhash.xxh64_intdigest(g.encode(), seed) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows, radius=4):
    label = {i: i for i in range(len(rows))}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= radius:
                label[max(root(i), root(j))] = min(root(i), root(j))
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(root(i), []).append(r[0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return [least[root(i)] for i in range(len(rows))]


def brute_near(rows, similarity=0.8):
    """Component ids by comparing all wide fingerprints with each other."""
    prints = [S.wide_simhash(r["text"], 5, 42) for r in rows]
    most = S.bits_of_similarity(similarity)
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sum((a ^ b).bit_count() for a, b in zip(prints[i], prints[j], strict=True)) <= most:
                label[max(root(i), root(j))] = min(root(i), root(j))
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(root(i), []).append(r["doc_id"])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return [least[root(i)] for i in range(len(rows))]


def test_near_copies_of_similarity_are_found_and_others_kept(spark):
    rng = random.Random(9)
    rows, of = [], {}
    for g in range(40):
        base = words(rng, "en", rng.randint(80, 400)).split()
        for c in range(4):
            copy = list(base)
            # an edit spoils five shingles: so many edits keep a similarity of 0.8 or more to the first
            for at in rng.sample(range(len(copy)), max(1, len(copy) // 60) if c else 0):
                copy[at] = "edited"
            rows.append((len(rows), " ".join(copy)))
            of[len(rows) - 1] = 4 * g
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(r["doc_id"] for r in S.simhash_dedup(docs).collect())
    assert kept == sorted(set(of.values()))


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    texts = [(r["doc_id"], brute_print(r["text"])) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    expected = {(d, f"{fp:016x}", c) for (d, fp), c in zip(texts, brute_components(texts), strict=True)}
    assert {tuple(r) for r in Q.op3_simhash_components(spark, sf).select("doc_id", "fingerprint", "component_id").collect()} == expected


def test_odd_documents(spark):
    docs = documents(spark)
    rows = [(r["doc_id"], brute_print(r["text"])) for r in docs.collect()]
    expected = sorted((str(d), f"{fp:016x}", str(c)) for (d, fp), c in zip(rows, brute_components(rows), strict=True))
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in S.simhash_components(docs).collect()) == expected
    assert S.simhash_components(empty(spark)).count() == 0
    kept = S.simhash_dedup(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) and set(ids) == set(brute_near(docs.collect()))
    assert S.simhash_dedup(empty(spark)).count() == 0


def test_repeated_ids_keep_one_row_for_each_component(spark):
    rng = random.Random(5)
    a, b = words(rng, "en", 200), words(rng, "de", 200)
    docs = spark.createDataFrame([(1, a), (1, b), (1, b), (2, a), (3, b)], "doc_id long, text string")
    assert sorted(r["text"] for r in S.simhash_dedup(docs).collect()) == sorted([a, b])


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7])
def test_bit_sliced_groups_equal_brute_force(radius):
    rng = np.random.default_rng(radius)
    for groups in (1, 3, 40, 600):
        base = rng.integers(0, 2**63, 30, dtype=np.uint64)
        f = base[rng.integers(0, 30, 1300)]
        for _ in range(6):
            f = f ^ (np.uint64(1) << rng.integers(0, 64, 1300).astype(np.uint64)) * rng.integers(0, 2, 1300).astype(np.uint64)
        keys = np.sort(rng.integers(0, groups, 1300))
        near = np.zeros((1300, 1300), np.int64)
        for b in range(64):
            bit = (f >> np.uint64(b) & np.uint64(1)).astype(np.int64)
            near += bit[:, None] != bit[None, :]
        one, two = np.nonzero((near <= radius) & (keys[:, None] == keys[None, :]))
        expected = S._roots(1300, one, two)
        found = S.group_roots(keys, f, radius)
        assert len(set(zip(found.tolist(), expected.tolist(), strict=True))) == len(set(found.tolist())) == len(set(expected.tolist()))


def test_hot_buckets_in_tiles_lose_no_link(spark, monkeypatch):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(3)]
    prints = sorted({b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for b in base for _ in range(150)})
    rows = [(i, p) for i, p in enumerate(prints)]
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in rows]
    df = spark.createDataFrame(signed, "id long, fp long")
    monkeypatch.setattr(S, "TILE", 20)
    found = {r["fp"]: r["component_id"] for r in S.fingerprint_classes(df, "id", 4).collect()}
    assert [found[p] for _, p in signed] == brute_components(rows)


def test_components_of_long_paths(spark):
    links = [(i, i + 1) for i in range(0, 300) if i % 100 != 99] + [(500, 400)]
    df = spark.createDataFrame(links, "u long, v long")
    roots = {r["node"]: r["root"] for r in S.components(df).collect()}
    assert all(roots[n] == n // 100 * 100 for n in range(1, 300) if n % 100 and n < 300) and roots[500] == 400
    assert S.components(df.limit(0)).count() == 0


def test_groups_whose_links_are_checked(monkeypatch):
    monkeypatch.setattr(S, "SMALL", 40)
    rng = np.random.default_rng(8)
    base = rng.integers(0, 2**63, (12, 2), dtype=np.uint64)
    rows = base[rng.integers(0, 12, 400)]
    for _ in range(9):
        rows = rows ^ (np.uint64(1) << rng.integers(0, 64, (400, 2)).astype(np.uint64)) * rng.integers(0, 2, (400, 2)).astype(np.uint64)
    keys = np.sort(np.concatenate([np.zeros(300, np.int64), rng.integers(1, 9, 100)]))
    far = lambda a, b: np.bitwise_count(rows[a] ^ rows[b]).sum(axis=1).astype(np.int64)
    one, two = np.nonzero(keys[:, None] == keys[None, :])
    linked = (np.bitwise_count(rows[one, 0] ^ rows[two, 0]) <= 7) & (far(one, two) <= 10)
    expected = S._roots(400, one[linked], two[linked])
    found = S.group_roots(keys, rows[:, 0].copy(), 7, lambda a, b: far(a, b) <= 10)
    assert len(set(zip(found.tolist(), expected.tolist(), strict=True))) == len(set(found.tolist())) == len(set(expected.tolist()))
    assert 12 < len(set(expected.tolist())) < 400
