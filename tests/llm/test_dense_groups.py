"""Groups in which nearly all rows are linked: what a task holds follows its rows, not their pairs."""

import tracemalloc

import numpy as np
import pytest

from broadsheet.llm import simhash as S


def dense(groups, size, words, flips, seed=0):
    """Keys and rows of words that differ from their group's base in a few bits."""
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, (groups, 1, words), dtype=np.uint64)
    rows = np.repeat(base, size, axis=1)
    for _ in range(flips):
        at = rng.integers(0, 64 * words, (groups, size))
        g, r = np.indices(at.shape)
        rows[g, r, at >> 6] ^= np.uint64(1) << (at & 63).astype(np.uint64)
    return np.repeat(np.arange(groups), size), rows.reshape(-1, words)


@pytest.mark.parametrize("size", [128, 512])
def test_memory_of_a_dense_flush_is_bounded(size):
    keys, rows = dense((1 << 15) // size, size, S.WIDE, 6)
    narrow, few = dense((1 << 15) // size, size, 1, 2)
    for run in (lambda: S.wide_group_roots(keys, rows, 70), lambda: S.group_roots(narrow, few[:, 0], 4)):
        tracemalloc.start()
        roots = run()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert (roots == np.arange(1 << 15) // size * size).all()
        assert peak < 80 << 20


def test_folded_links_equal_all_links():
    rng = np.random.default_rng(8)
    words = rng.integers(0, 1 << 63, (600, S.WIDE), dtype=np.uint64) & rng.integers(0, 1 << 63, (600, S.WIDE), dtype=np.uint64)
    keys = np.sort(rng.integers(0, 40, 600))
    apart = np.bitwise_count(words[:, None] ^ words[None]).sum(axis=2)
    for most in (70, 85, 100):
        one, two = np.nonzero((apart <= most) & (keys[:, None] == keys[None]))
        assert (S.wide_group_roots(keys, words, most) == S._roots(600, one, two)).all()
