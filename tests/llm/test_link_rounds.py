"""What goes into the components follows the rows of a group of near copies, not rows times tables."""

import random

import numpy as np

from broadsheet.llm import simhash as S
from tests.llm.helpers import words


def test_near_copies_are_not_linked_again_in_each_table(spark, monkeypatch):
    rng = random.Random(7)
    base = words(rng, "en", 250).split()
    texts = []
    for i in range(400):
        copy = list(base)
        copy[rng.randrange(250)] = f"edit{i}"
        texts.append(" ".join(copy))
    apart = [words(rng, "de", 120) for _ in range(20)]
    counts, components = [], S.components
    monkeypatch.setattr(S, "components", lambda links, *a: counts.append(links.distinct().count()) or components(links, *a))
    docs = spark.createDataFrame(list(enumerate(texts + apart)), "doc_id long, text string")
    kept = sorted(r["doc_id"] for r in S.simhash_dedup(docs).collect())
    assert kept == [0, *range(400, 420)]
    assert len(texts) <= sum(counts) < 12 * len(texts)


def test_known_classes_are_joined_only_to_others():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, (30, S.WIDE), dtype=np.uint64)
    of = rng.integers(0, 30, 1500)
    prints = base[of]
    for _ in range(14):
        prints = prints ^ (np.uint64(1) << rng.integers(0, 64, prints.shape).astype(np.uint64)) * rng.integers(0, 2, prints.shape).astype(np.uint64)
    keys = np.sort(rng.integers(0, 6, 1500))
    known = np.where(rng.random(1500) < 0.5, of, np.arange(1500) + 100)
    first = S._first_of_class(keys, known)
    same = (keys[:, None] == keys[None]) & (known[:, None] == known[None])
    assert (first == same.argmax(axis=1)).all()
    apart = np.bitwise_count(prints[:, None] ^ prints[None]).sum(axis=2)
    one, two = np.nonzero(same | ((apart <= 50) & (keys[:, None] == keys[None])))
    assert (S.wide_group_roots(keys, prints, 50, first) == S._roots(1500, one, two)).all()
