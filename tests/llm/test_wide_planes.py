"""The near-copy stage compares wide fingerprints as bit planes, like op3 does its 64 bits."""

import numpy as np
import pytest

from broadsheet.llm import simhash as S
from tests.llm.test_dense_groups import dense


@pytest.fixture
def compared(monkeypatch):
    """Pairs of a row and a word given to the bit-sliced comparison, call by call."""
    calls, within = [], S._within
    monkeypatch.setattr(S, "_within", lambda planes, query, word, *a: calls.append(len(word)) or within(planes, query, word, *a))
    return calls


@pytest.mark.parametrize("size", [1, 2, 63, 64, 65, 700, 2100])
def test_bit_sliced_wide_groups_equal_brute_force(compared, size):
    rng = np.random.default_rng(size)
    base = rng.integers(0, 1 << 63, (12, S.WIDE), dtype=np.uint64)
    words = base[rng.integers(0, 12, 2100)]
    for _ in range(16):
        words = words ^ (np.uint64(1) << rng.integers(0, 64, words.shape).astype(np.uint64)) * rng.integers(0, 2, words.shape).astype(np.uint64)
    words[::5] = rng.integers(0, 1 << 63, (420, S.WIDE), dtype=np.uint64)
    keys = np.arange(2100) // size
    apart = np.zeros((2100, 2100), np.int64)
    for w in words.T:
        apart += np.bitwise_count(w[:, None] ^ w[None])
    for most in (0, 31, 50, 70):
        one, two = np.nonzero((apart <= most) & (keys[:, None] == keys[None]))
        assert (S.wide_group_roots(keys, words, most) == S._roots(2100, one, two)).all()
    assert (sum(compared) > 0) == (size > 1)


def test_a_large_group_of_near_copies_costs_less_than_its_pairs(compared):
    keys, words = dense(1, 1 << 13, S.WIDE, 6)
    assert (S.wide_group_roots(keys, words, 70) == 0).all()
    assert 0 < sum(compared) < len(keys) * (len(keys) // 64) // 20
