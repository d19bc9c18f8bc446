"""Statistics of a text's words and lines."""

from __future__ import annotations

import re

import numpy as np

WINDOW = 8
_SYMBOLS = re.compile(r"[#*$%&|<>]")
_BLANK = str.maketrans("", "", " \t\n\x0b\x0c\r")
#: Odd multipliers that mix word numbers into a window's hash.
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of WINDOW words that stand in the list twice or more, the first one included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint64, len(words))
    if len(number) == len(words):
        return 0
    h = np.zeros(n, np.uint64)
    mixed = (ids + np.uint64(1)) * np.uint64(0xFF51AFD7ED558CCD)
    mixed ^= mixed >> np.uint64(33)
    for i in range(WINDOW):
        h += mixed[i : i + n] * _MIX[i]
    _, back, count = np.unique(h, return_inverse=True, return_counts=True)
    at = np.flatnonzero(count[back] > 1)
    if not len(at):
        return 0
    # The hash only proposes; the windows themselves decide.
    rows = np.lib.stride_tricks.sliding_window_view(ids, WINDOW)[at]
    order = np.lexsort(rows.T)
    same = (rows[order[1:]] == rows[order[:-1]]).all(axis=1)
    twice = np.zeros(len(at), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, at[twice], 1)
    np.add.at(edge, at[twice] + WINDOW, -1)
    return int((np.cumsum(edge) > 0).sum())


def text_stats(text: str | None) -> tuple[int, int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_distinct words and n_lines with a word."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()  # at ASCII white space
    lines = [x for x in text.split("\n") if x.translate(_BLANK)] if "\n" in text else [text] * bool(words)
    blanks = sum(map(text.count, " \t\n\x0b\x0c\r"))
    return len(words), len(text) - blanks, len(_SYMBOLS.findall(text)), len(lines) - len(set(lines)), repeated_words(words), len(set(words)), len(lines)
