"""Ratios of matching blocks (Ratcliff-Obershelp) with a bound that spares most of them.

Matching blocks stand in the same order in both strings, so they are a common subsequence: no ratio
exceeds that of the longest one. Its length comes from a few operations on long integers for each
character, for any number of strings at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from difflib import SequenceMatcher


class Title:
    """A string that others are compared with; what a comparison needs is worked out once."""

    __slots__ = ("_matcher", "_places", "key", "words")

    def __init__(self, key: str):
        self.key, self.words = key, frozenset(key.split())
        self._matcher: SequenceMatcher | None = None
        self._places: dict[str, int] | None = None

    @property
    def places(self) -> dict[str, int]:
        """For each character the places where it stands, as bits."""
        if self._places is None:
            found: dict[str, list[int]] = {}
            for i, c in enumerate(self.key):
                found.setdefault(c, []).append(i)
            self._places = {}
            for c, at in found.items():
                bits = bytearray(len(self.key) // 8 + 1)
                for i in at:
                    bits[i >> 3] |= 1 << (i & 7)
                self._places[c] = int.from_bytes(bits, "little")
        return self._places

    def ratio(self, key: str) -> float:
        """SequenceMatcher(None, key, self.key).ratio()"""
        if self._matcher is None:
            self._matcher = SequenceMatcher(None, "", self.key)
        self._matcher.set_seq1(key)
        return self._matcher.ratio()

    def shared(self, words: frozenset[str]) -> float:
        """Share of the words of the one with fewer that both have."""
        return len(words & self.words) / max(min(len(words), len(self.words)), 1)


def common_lengths(key: str, others: Sequence[Title]) -> list[int]:
    """Lengths of the longest common subsequences of key and each other string.

    The strings lie side by side in one integer, with a bit between them that takes the carry.
    """
    places = dict.fromkeys(key, 0)
    full, starts, at = 0, [], 0
    for other in others:
        starts.append(at)
        full |= ((1 << len(other.key)) - 1) << at
        for c, bits in other.places.items():
            if c in places:
                places[c] |= bits << at
        at += len(other.key) + 1
    row = full
    for c in key:
        if hit := row & places[c]:
            row = ((row + hit) | (row - hit)) & full
    return [len(o.key) - ((row >> s) & ((1 << len(o.key)) - 1)).bit_count() for s, o in zip(starts, others, strict=True)]


def ratio_bounds(key: str, others: Sequence[Title]) -> list[float]:
    """What SequenceMatcher's ratio of key and each other string can't exceed."""
    return [2.0 * n / (len(key) + len(o.key)) if key or o.key else 1.0 for n, o in zip(common_lengths(key, others), others, strict=True)]


def likest(key: str, others: Sequence[Title], least: float, slack: float = 0.00011) -> list[tuple[int, float]]:
    """(place, score) of the others most like key: of those with a score of ``least`` or more the best, by blocks or by words.

    All that come within slack of the best or of least are given, so scores may be rounded to four
    digits afterwards.
    """
    words, n = frozenset(key.split()), len(key)
    scores = [o.shared(words) for o in others]
    best = max(scores, default=0.0)
    # A ratio of r needs lengths no further apart than this.
    open_ = [i for i, o in enumerate(others) if scores[i] < 1.0 and 2 * min(n, len(o.key)) >= least * (n + len(o.key))]
    bounds = ratio_bounds(key, [others[i] for i in open_]) if open_ and best < 1.0 else []
    for bound, i in sorted(zip(bounds, open_, strict=False), reverse=True):
        if bound < max(least, best) - slack:
            break
        scores[i] = max(scores[i], others[i].ratio(key))
        best = max(best, scores[i])
    return [(i, s) for i, s in enumerate(scores) if s >= max(least, best) - slack]
