"""Exact byte-pair encoding with a bounded cache of words.

A byte-level BPE tokenizer first splits a text into pre-tokens and merges within each alone, so a
text cut at pre-token borders has the ids of its parts in a row. ``chunks`` cuts only where the
split pattern always has a border: before a space that a visible character follows, around a lone
line feed between visible characters and, in a text without runs of punctuation, before a full stop
or comma. Parts recur, so most are looked up; each new one is encoded by the tokenizers library.
"""

from __future__ import annotations

import os
import re
from itertools import islice

import numpy as np

#: Characters that no tokenizer takes for white space.
_SEEN = "!-~¡-ᙿ、-퟿"
_ODD = re.compile(f" (?![{_SEEN}])")
_CUT = re.compile(f"(?= [{_SEEN}])")
_VISIBLE = re.compile(f"[{_SEEN}]")
_LATIN = "A-Za-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
#: A separator, full stop or comma in a place where the quick cut isn't sure to be right.
_BENT = re.compile(f"[ \n.,\0](?:(?<=[ \n])(?![{_SEEN}])|(?<=[^{_SEEN}]\n)|(?<=[.,])(?![ \n{_LATIN}]|\\Z)|(?<=[^{_LATIN}][.,])|(?<=\0))")


def _spaced(line: str) -> list[str]:
    if _ODD.search(line):
        return [x for x in _CUT.split(line) if x]
    first, *rest = line.split(" ")
    return [first, *[" " + x for x in rest]] if first else [" " + x for x in rest]


def chunks(text: str) -> list[str]:
    """Parts that join to the text and are encoded independently of each other."""
    if not text:
        return []
    if text[0] not in " \n.," and not _BENT.search(text):
        return text.replace(" ", "\0 ").replace(",", "\0,").replace(".", "\0.").replace("\n", "\0\n\0").split("\0")
    if "\n" not in text:
        return _spaced(text)
    out: list[str] = []
    lines = text.split("\n")
    held = lines[0]
    for line in lines[1:]:
        if held and line and _VISIBLE.match(held[-1]) and _VISIBLE.match(line[0]):
            out += _spaced(held)
            out.append("\n")
            held = line
        else:
            held = f"{held}\n{line}"
    return out + _spaced(held)


class Encoder:
    """Encodes with the tokenizer file at ``path``; special tokens in a text are ordinary text.

    ``entries`` bounds the cache; parts longer than ``longest`` code points are never kept. When the
    cache is full its older half stays, which holds the parts met first and so the common ones.
    """

    #: Code points of new parts that are encoded in one call.
    JOINED = 1 << 15

    def __init__(self, path: str, entries: int = 800_000, longest: int = 48):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        self._tokenizer.no_padding()
        self._tokenizer.no_truncation()
        self.entries, self._longest = entries, longest
        self._known: dict[str, bytes] = {}
        vocabulary = self._tokenizer.get_vocab()
        #: Bytes of text that each id stands for: a byte-level vocabulary spells a byte as a character.
        self.widths = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.widths[list(vocabulary.values())] = [len(x) for x in vocabulary]

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, "<u4") for x in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, missing: list[str]) -> dict[str, bytes]:
        """Values of new parts. Those that begin with a space and a visible character are joined, encoded at once and parted by their widths."""
        spaced: list[str] = []
        single: list[str] = []
        for x in missing:
            (spaced if x[0] == " " and (" !" <= x[:2] <= " ~" or len(x) > 1 and _VISIBLE.match(x[1])) else single).append(x)
        found = {x: ids.tobytes() for x, ids in zip(single, self._encoded(single), strict=True)}
        group: list[str] = []
        size = 0
        for x in [*spaced, ""]:
            if group and (not x or size + len(x) > self.JOINED):
                whole = "".join(group)
                ids = self._encoded([whole])[0]
                lengths = map(len, group) if whole.isascii() else (len(y.encode()) for y in group)
                ends = np.searchsorted(np.cumsum(self.widths[ids]), np.cumsum(np.fromiter(lengths, np.int64, len(group)))) + 1
                data, begin = ids.tobytes(), 0
                for y, end in zip(group, (4 * ends).tolist(), strict=True):
                    found[y] = data[begin:end]
                    begin = end
                group, size = [], 0
            group.append(x)
            size += len(x)
        if len(self._known) + len(found) > self.entries:
            self._known = dict(islice(self._known.items(), self.entries // 2))
        room = self.entries - len(self._known)
        self._known.update(islice(((k, v) for k, v in found.items() if len(k) <= self._longest), room) if len(found) > room or max(map(len, found), default=0) > self._longest else found)
        return found

    def forget(self) -> None:
        """Empties the cache, so that a worker that goes on to other work doesn't hold it."""
        self._known = {}

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        parts = [chunks(x) for x in texts]
        values = [list(map(self._known.get, line)) for line in parts]
        holes = [(line, row, [i for i, v in enumerate(row) if v is None]) for line, row in zip(parts, values, strict=True) if None in row]
        if holes:
            found = self._learn(list(dict.fromkeys(line[i] for line, _, at in holes for i in at)))
            for line, row, at in holes:
                for i in at:
                    row[i] = found[line[i]]
        return list(map(b"".join, values))

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """First and past-the-last code point of each token of a text.

        A token that holds only some bytes of a character spans that character.
        """
        return self.spans_of(text, self.ids([text])[0])

    def spans_of(self, text: str, ids: bytes) -> tuple[np.ndarray, np.ndarray]:
        ends = np.cumsum(self.widths[np.frombuffer(ids, "<u4")])
        if not len(ends):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        begins = np.concatenate([[0], ends[:-1]])
        if text.isascii():
            return begins, ends
        at = np.cumsum((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80) - 1
        return at[begins], at[ends - 1] + 1


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str, entries: int = 800_000) -> Encoder:
    """One encoder per worker process and file; the last caller says how large its cache may grow."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    _ENCODERS[path].entries = entries
    return _ENCODERS[path]
