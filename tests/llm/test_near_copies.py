import random

import numpy as np

from broadsheet.llm import simhash as S
from tests.llm.helpers import words


def jaccard(a, b):
    grams = [{tuple(x.split()[i : i + 5]) for i in range(len(x.split()) - 4)} for x in (a, b)]
    return len(grams[0] & grams[1]) / len(grams[0] | grams[1])


def pairs(rng, share, n, length=300):
    """n pairs of texts that share the first part of their words."""
    out = []
    for _ in range(n):
        base = words(rng, "en", length).split()
        cut = int(share * length)
        out.append((" ".join(base), " ".join(base[:cut] + words(rng, "en", length - cut).split())))
    return out


def test_texts_below_the_similarity_are_kept(spark):
    rng = random.Random(4)
    apart = pairs(rng, 0.85, 60)  # about 0.73
    assert all(0.6 < jaccard(a, b) < 0.8 for a, b in apart)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(x for p in apart for x in p)], "doc_id long, text string")
    assert S.simhash_dedup(docs).count() == 2 * len(apart)


def test_exact_classes_equal_brute_force():
    rng = np.random.default_rng(2)
    sets = []
    for _ in range(12):
        base = rng.integers(0, 2**63, int(rng.integers(1, 60)), dtype=np.uint64)
        for _ in range(10):
            sets.append(np.unique(np.concatenate([base[rng.random(len(base)) > 0.1], rng.integers(0, 2**63, int(rng.integers(1, 4)), dtype=np.uint64)])))
    like = lambda a, b: len(np.intersect1d(a, b)) / len(np.union1d(a, b)) >= 0.8
    one, two = zip(*[(i, j) for i in range(len(sets)) for j in range(i) if like(sets[i], sets[j])], strict=True)
    expected = S._roots(len(sets), np.array(one), np.array(two))
    found = S.jaccard_roots(sets, 0.8)
    assert len(set(zip(found.tolist(), expected.tolist(), strict=True))) == len(set(found.tolist())) == len(set(expected.tolist())) < len(sets)


def test_tiles_of_a_large_group_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(S, "SET_TILE", 900)
    rng = random.Random(6)
    base = words(rng, "en", 200).split()
    rows = [(i, " ".join([*base[:i], f"edit{i}", *base[i + 1 :]])) for i in range(20)] + [(None, " ".join(base))]
    assert S.simhash_dedup(spark.createDataFrame(rows, "doc_id long, text string")).count() == 1


def test_pairs_at_the_similarity_are_found(spark):
    rng = random.Random(12)
    near = [p for p in pairs(rng, 0.895, 500) if jaccard(*p) >= 0.8]
    assert len(near) == 500 and max(jaccard(*p) for p in near) < 0.82
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(x for p in near for x in p)], "doc_id long, text string")
    assert S.simhash_dedup(docs).count() == len(near)


def test_combined_recall():
    assert S.recall(0.8) > 0.9997 and S.recall(0.82) > 0.9999
