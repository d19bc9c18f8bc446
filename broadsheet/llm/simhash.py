"""SimHash near-duplicates with bit-sliced comparison.

1. A 64-bit fingerprint of each text's word shingles (Arrow stage; the text goes no further).
2. Equal fingerprints become one class: copies never meet each other.
3. Distinct fingerprints are dealt into buckets: cut into b bit blocks, two that differ in at most r
   bits agree in b - r blocks, so each enters one bucket for each choice of b - r blocks. This is
   exact. b follows the number of fingerprints, so that buckets stay small.
4. In a bucket the fingerprints are stored as 64 bit planes. XOR with a query's bits gives 64
   difference bits a word; carry-save adders count them plane by plane in bit-sliced counters; a
   word (a block of 64 fingerprints) is abandoned once all its counters exceed the radius.
5. A bucket gives a star for each connected class in it, never its pairs; stars join to components
   by large-star and small-star rounds, in DataFrames.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator
from itertools import combinations
from math import acos, comb, pi

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import FEW_FILES, cut, files_for, of_texts, stored, structs, wrapped

#: Distinct fingerprints of one bucket that one task compares; larger buckets are split in tiles.
TILE = 1 << 15
#: Groups up to here are compared together, as lists of (query, word).
SMALL = 512
WORDS_AT_ONCE = 1 << 18
#: The same for wide fingerprints.
WIDE_AT_ONCE = 1 << 14


def simhash(text: str | None, words_in_shingle: int, seed: int) -> int:
    """Fingerprint (unsigned) of a text; 0 for none or one without a word.

    A-Z are lowered; words are what ASCII white space parts; a text of fewer words is one shingle.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    k = words_in_shingle
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    h = np.array([xxhash.xxh64_intdigest(x, seed) for x in shingles], "<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 14):
        ones += np.unpackbits(h[i : i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprint(text: Column, words_in_shingle: int = 4, seed: int = 42) -> Column:
    """The fingerprint of a text column as a (signed) long."""

    def of(texts: list[str | None]) -> pa.Array:
        return pa.array(np.array([simhash(x, words_in_shingle, seed) for x in texts], np.uint64).view(np.int64))

    return of_texts("long", of)(text)


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _planes(fps: np.ndarray) -> np.ndarray:
    """Bit planes: row b holds bit b of all fingerprints, 64 in a word. fps: one word each, or a row of words."""
    words = fps.reshape(len(fps), -1)
    padded = np.zeros((-(-len(fps) // 64) * 64, words.shape[1]), np.uint64)
    padded[: len(fps)] = words
    bits = np.unpackbits(padded.view(np.uint8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)


def _within(planes: np.ndarray, query: np.ndarray, word: np.ndarray, lanes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """For pairs of a query fingerprint and a word: which pairs have lanes within the radius, and the lanes.

    query: one word for each pair, or a row for each word of the fingerprint. lanes: the lanes that
    count. Counters have as many bits as the radius, and a sticky overflow.
    """
    query = np.atleast_2d(query)
    width = radius.bit_length()
    counters = [np.zeros(len(word), np.uint64) for _ in range(max(width, 1))]
    over = ~lanes
    at = np.arange(len(word))

    def add(x: np.ndarray, level: int) -> None:
        nonlocal over
        for i in range(level, len(counters)):
            carry = counters[i] & x
            counters[i] = counters[i] ^ x
            x = carry
        over = over | x

    def beyond() -> np.ndarray:
        more, equal = np.zeros_like(over), ~np.zeros_like(over)
        for i in reversed(range(len(counters))):
            if radius >> i & 1:
                equal = equal & counters[i]
            else:
                more = more | (equal & counters[i])
                equal = equal & ~counters[i]
        return over | more

    def differs(b: int) -> np.ndarray:
        return planes[b][word] ^ -((query[b >> 6] >> np.uint64(b & 63)) & np.uint64(1))

    pause = 9 * len(query)
    for b in range(0, len(planes) - 1, 3):
        x, y, z = differs(b), differs(b + 1), differs(b + 2)
        add(x ^ y ^ z, 0)  # full adder: a sum bit, and a carry bit of twice its worth
        add((x & y) | (z & (x ^ y)), 1)
        if b % pause == pause - 3:
            over = beyond()
            alive = np.flatnonzero(~over)
            if len(alive) < len(word) // 2 or not len(alive):
                at, query, word, over = at[alive], query[:, alive], word[alive], over[alive]
                counters = [c[alive] for c in counters]
                if not len(alive):
                    return at, over
    add(differs(len(planes) - 1), 0)
    near = ~beyond()
    alive = np.flatnonzero(near)
    return at[alive], near[alive]


_ONE, _ALL = np.uint64(1), ~np.uint64(0)


def _lanes_between(word: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mask of those lanes of a word whose row number is in [begin, end)."""
    low = np.clip(begin - 64 * word, 0, 64)
    high = np.clip(end - 64 * word, 0, 64)
    ones = lambda n: np.where(n >= 64, _ALL, (_ONE << np.minimum(n, 63).astype(np.uint64)) - _ONE)
    return ones(high) & ~ones(low)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row of each row's class under the links (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while not np.array_equal(label, label[label]):
            label = label[label]
        if np.array_equal(label, before):
            break
    return label


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the classes of rows a and b; label holds each row's smallest row, before and after."""
    a, b = label[a], label[b]
    apart = a != b
    if apart.any():
        label[:] = _roots(len(label), a[apart], b[apart])[label]


#: Tells which proposed pairs of rows are links.
Check = Callable[[np.ndarray, np.ndarray], np.ndarray]


def _small_groups(fps: np.ndarray, end: np.ndarray, radius: int, check: Check | None = None) -> np.ndarray:
    """Roots for rows in groups; end[i] is where row i's group ends. Groups have at most SMALL rows.

    Links are folded into classes as they are found, so what is held follows the rows, not the pairs.
    """
    planes, rows, label = _planes(fps), np.arange(len(fps)), np.arange(len(fps))
    first, last = (rows + 1) // 64, (end - 1) // 64
    count = np.where(end > rows + 1, last - first + 1, 0)
    begin = 0
    total = np.cumsum(count)
    while begin < len(fps):
        stop = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + WORDS_AT_ONCE)))
        n = count[begin:stop]
        query = np.repeat(rows[begin:stop], n)
        word = np.repeat(first[begin:stop], n) + np.arange(len(query)) - np.repeat(np.cumsum(n) - n, n)
        at, near = _within(planes, fps[query], word, _lanes_between(word, query + 1, end[query]), radius)
        for lane in range(64):
            hit = np.flatnonzero(near >> np.uint64(lane) & _ONE)
            one, two = query[at[hit]], 64 * word[at[hit]] + lane
            apart = label[one] != label[two]
            one, two = one[apart], two[apart]
            if len(one):
                linked = check(one, two) if check else slice(None)
                _unite(label, one[linked], two[linked])
        begin = stop
    return label


def _large_group(fps: np.ndarray, radius: int, check: Check | None = None) -> np.ndarray:
    """Roots of one group: breadth first, each row compared only with those that no class has yet."""
    n, planes = len(fps), _planes(fps)
    open_ = _lanes_between(np.arange(planes.shape[1]), np.zeros(planes.shape[1], np.int64), np.full(planes.shape[1], n))
    label = np.full(n, -1)

    def near(rows: np.ndarray) -> np.ndarray:
        """Open rows near any of these, no longer open then."""
        found = []
        for i in range(0, len(rows), 64):
            some = rows[i : i + 64]
            words = np.flatnonzero(open_)
            if not len(words):
                break
            query, word = np.repeat(some, len(words)), np.tile(words, len(some))
            most = WORDS_AT_ONCE // 16 if check else WORDS_AT_ONCE
            for j in range(0, len(query), most):
                q, w = query[j : j + most], word[j : j + most]
                at, hits = _within(planes, fps[q], w, open_[w], radius)
                if len(at) and check:
                    lanes = np.unpackbits(hits.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                    pair, lane = np.nonzero(lanes)
                    lanes[pair, lane] = check(q[at[pair]], 64 * w[at[pair]] + lane)
                    hits = np.packbits(lanes, axis=1, bitorder="little").view(np.uint64).ravel()
                if len(at):
                    mask = np.zeros(planes.shape[1], np.uint64)
                    np.bitwise_or.at(mask, w[at], hits)
                    open_[:] &= ~mask
                    new = np.flatnonzero(np.unpackbits(mask.view(np.uint8), bitorder="little"))
                    found.append(new)
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    for seed in range(n):
        if label[seed] >= 0:
            continue
        label[seed] = seed
        open_[seed >> 6] &= ~(_ONE << np.uint64(seed & 63))
        frontier = np.array([seed])
        while len(frontier):
            frontier = near(frontier)
            label[frontier] = seed
    return label


def group_roots(keys: np.ndarray, fps: np.ndarray, radius: int, check: Check | None = None) -> np.ndarray:
    """For rows sorted by key: row number of the root of each row's class within its group.

    check: where the fingerprints only propose, tells which pairs of rows are links.
    """
    if not len(keys):
        return np.zeros(0, np.int64)
    begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.concatenate([begins, [len(keys)]]))
    out = np.arange(len(keys))
    for begin, size in zip(begins[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist(), strict=True):
        own = (lambda a, b, n=begin: check(a + n, b + n)) if check else None
        out[begin : begin + size] = begin + _large_group(fps[begin : begin + size], radius, own)
    small = (sizes > 1) & (sizes <= SMALL)
    rows = np.flatnonzero(np.repeat(small, sizes))
    if len(rows):
        ends = np.repeat(np.cumsum(sizes[small]), sizes[small])
        own = (lambda a, b: check(rows[a], rows[b])) if check else None
        out[rows] = rows[_small_groups(fps[rows], ends, radius, own)]
    return out


def _first_of_class(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """For rows sorted by key: the first row of each row's group that is of the same known class."""
    order = np.lexsort((known, keys))
    new = np.concatenate([[True], (keys[order][1:] != keys[order][:-1]) | (known[order][1:] != known[order][:-1])])
    first = np.empty(len(keys), np.int64)
    first[order] = order[new][np.cumsum(new) - 1]
    return first


def wide_group_roots(keys: np.ndarray, words: np.ndarray, most: int, label: np.ndarray | None = None) -> np.ndarray:
    """Like group_roots, for rows of several words: links are all pairs of a group that differ in ``most`` bits at most.

    Bit-sliced as well. A row isn't compared with words whose rows are all of its class by then, so a
    group of near copies costs far less than its pairs. label: of classes known before, each row's
    first row in its group.
    """
    if not len(keys):
        return np.zeros(0, np.int64)
    begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.concatenate([begins, [len(keys)]]))
    end = np.repeat(begins + sizes, sizes)
    planes, fps, rows, label = _planes(words), np.ascontiguousarray(words.T), np.arange(len(keys)), np.arange(len(keys)) if label is None else label.copy()
    first, last = (rows + 1) // 64, (end - 1) // 64
    count = np.where(end > rows + 1, last - first + 1, 0)
    total = np.cumsum(count)
    begin = 0
    while begin < len(rows):
        stop = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + WIDE_AT_ONCE)))
        n = count[begin:stop]
        query = np.repeat(rows[begin:stop], n)
        word = np.repeat(first[begin:stop], n) + np.arange(len(query)) - np.repeat(np.cumsum(n) - n, n)
        low, high = (f.reduceat(label, rows[::64])[word] for f in (np.minimum, np.maximum))
        apart = np.flatnonzero((low != high) | (low != label[query]))
        query, word = query[apart], word[apart]
        at, near = _within(planes, fps[:, query], word, _lanes_between(word, query + 1, end[query]), most)
        for i, lanes in enumerate(near.view(np.uint8).reshape(-1, 8).T):
            pair, lane = np.nonzero(np.unpackbits(lanes[:, None], axis=1, bitorder="little"))
            if len(pair):
                _unite(label, query[at[pair]], 64 * word[at[pair]] + 8 * i + lane)
        begin = stop
    return label


def _stars(radius: int, wide: bool = False):
    """Links of groups in rows (key, words of the fingerprint) sorted by key: (u, v), v the root.

    With one word its value is the node. With several (wide), rows are (key, row's node, known, words),
    and known, the class that the node is of already, takes its place: a group has at most a link for each class.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            key, node, own = rows[0], rows[1], np.arange(len(rows[0]))
            if wide:
                node = rows[2]
                first = _first_of_class(key, node)
                roots = wide_group_roots(key, np.stack([x.view(np.uint64) for x in rows[3:]], axis=1), radius, first)
            else:
                first, roots = own, group_roots(key, node.view(np.uint64), radius)
            at = np.flatnonzero((roots != own) & (first == own))
            if len(at):
                yield pa.record_batch([pa.array(node[at]), pa.array(node[roots[at]])], names=["u", "v"])

        rows: list[np.ndarray] = []
        for batch in batches:
            new = [c.to_numpy() for c in batch.columns]
            rows = [np.concatenate(p) for p in zip(rows, new, strict=True)] if rows else new
            if len(rows[0]) >= 1 << 15 and rows[0][0] != rows[0][-1]:  # all but the last group is whole
                whole = int(np.searchsorted(rows[0], rows[0][-1]))
                yield from links([r[:whole] for r in rows])
                rows = [r[whole:] for r in rows]
        if rows:
            yield from links(rows)

    return run


def bucket_scheme(n: int, radius: int, bits: int = 64) -> int:
    """Number of bit blocks so that a bucket is expected to hold some tens of n spread fingerprints."""
    for blocks in range(radius + 1, radius + 5):
        if n <= 32 << int(bits * (blocks - radius) / blocks):
            return blocks
    return radius + 4


def link_stars(distinct: DataFrame, radius: int, n: int) -> DataFrame:
    """Links (u, v) between distinct fingerprints (long column fp) that join what is within radius."""
    blocks = bucket_scheme(n, radius)
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    kept = []
    for number, some in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum((1 << edges[i + 1]) - (1 << edges[i]) for i in some)
        mask = mask - (1 << 64) if mask >> 63 else mask
        kept.append(F.xxhash64(F.lit(number), F.col("fp").bitwiseAND(F.lit(mask).cast("long"))))
    # Keys are hashes: buckets that share one are compared together, which adds no link beyond the radius.
    rows = distinct.select(F.explode(F.array(*kept)).alias("key"), "fp")
    return _dealt(rows, "fp").mapInArrow(_stars(radius), "u long, v long")


def _dealt(rows: DataFrame, node: str, tile: int | None = None, weight: Column | None = None) -> DataFrame:
    """Rows of buckets (key, node, ...) dealt out and sorted by key; of a bucket that weighs over a tile, each pair of tiles is a bucket.

    A row weighs 1 and a tile TILE unless told.
    """
    tile = tile or TILE
    sizes = rows.groupBy("key").agg(F.sum(F.lit(1) if weight is None else weight).alias("count"))
    large = cut(sizes.filter(F.col("count") > tile).select("key", F.ceil(F.col("count") / tile).cast("int").alias("tiles")), FEW_FILES)
    tiled = rows
    if not large.isEmpty():
        both = rows.join(large, "key", "left")
        own = F.pmod(F.xxhash64(node), F.col("tiles")).cast("int")
        pairs = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda t: F.xxhash64("key", F.least(own, t), F.greatest(own, t)))
        some = F.explode(F.when(F.col("tiles").isNull(), F.array("key")).otherwise(pairs)).alias("key")
        tiled = both.select(some, *[c for c in rows.columns if c != "key"])
    return tiled.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key").sortWithinPartitions("key", node)


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for each node of the links: root is the smallest node of its component.

    Large-star and small-star rounds in turn; each halves the paths or better. A hot centre has one
    row on the side of the minima, so its links are a skewed join, which AQE splits. The table is cut
    already.
    """

    def minima(arrows: DataFrame) -> DataFrame:
        return arrows.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))

    edges = cut(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct())

    def seal(x: DataFrame) -> tuple:
        return tuple(x.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    mark = seal(edges)
    for _ in range(most_rounds):
        if not mark[0]:
            break
        both = edges.select(F.col("u").alias("a"), F.col("v").alias("b")).unionByName(edges.select(F.col("v").alias("a"), F.col("u").alias("b")))
        large = both.filter("b > a").join(minima(both), "a").select(F.col("b").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        down = large.select(F.col("u").alias("a"), F.col("v").alias("b"))
        low = minima(down)
        small = down.join(low, "a").select(F.col("b").alias("u"), F.col("m").alias("v")).unionByName(low.select(F.col("a").alias("u"), F.col("m").alias("v")))
        edges = cut(small.filter("u <> v").distinct(), files_for(2 * mark[0]))
        mark, before = seal(edges), mark
        if mark == before:
            break
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def fingerprint_classes(prints: DataFrame, id_col: str, radius: int) -> DataFrame:
    """(fp, root, component_id) for each distinct fingerprint of prints (id_col, fp).

    root: the smallest fingerprint of its component. component_id: the smallest id of its component (null ids count only where there is no other).
    """
    distinct = cut(prints.groupBy("fp").agg(F.min(id_col).alias("least")))
    links = link_stars(distinct, radius, distinct.count())
    roots = components(links)
    linked = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    return linked.select("fp", "root").join(least, "root").select("fp", "root", "component_id")


def _marked(docs: DataFrame, id_col: str, text_col: str, words_in_shingle: int, seed: int, radius: int) -> DataFrame:
    """(id, fp, root, component_id) for each row; hot fingerprints are a skewed join, which AQE splits."""
    prints = cut(docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), words_in_shingle, seed).alias("fp")))
    return prints.join(fingerprint_classes(prints, "id", radius), "fp")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_in_shingle: int = 4, seed: int = 42, radius: int = 4) -> DataFrame:
    """id, fingerprint (16 hex digits) and component_id of each row of docs.

    Texts that are null, empty or without a word have fingerprint zero and are linked like others.
    Repeated rows each get a row. Other columns are not read. An empty table gives no rows.
    """
    marked = _marked(docs, id_col, text_col, words_in_shingle, seed, radius)
    return marked.select(F.col("id").alias(id_col), hex_of(F.col("fp")).alias("fingerprint"), "component_id")


#: Words of a wide fingerprint. It only proposes: tables of sampled bits bring pairs together, those
#: within SLACK standard deviations of the similarity's bits are compared by their shingles.
WIDE, TABLES, SAMPLED, SLACK = 4, 80, 11, 5.5
#: Tables of the first round. Near copies meet in nearly all tables; what the first ones join is one class in the others.
FIRST = 8
#: Shingles of one group that one task compares; larger groups are split in tiles.
SET_TILE = 1 << 19
_SPREAD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def shingle_set(text: str | None, words_in_shingle: int, seed: int) -> np.ndarray:
    """Hashes of the distinct shingles of a text, sorted; none for one without a word. Words are those of simhash()."""
    words = (text or "").encode().lower().split()
    k = words_in_shingle
    shingles = {b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else ()
    return np.unique(np.array([xxhash.xxh64_intdigest(x, seed) for x in shingles], np.uint64))


def _wide_of(h: np.ndarray) -> list[int]:
    if not len(h):
        return [0] * WIDE
    out = []
    for spread in _SPREAD:
        x = h * spread
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xFF51AFD7ED558CCD)
        x ^= x >> np.uint64(29)
        ones = np.zeros(64, np.int64)
        for i in range(0, len(x), 1 << 14):
            ones += np.unpackbits(x[i : i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out.append(int(np.packbits(2 * ones > len(x), bitorder="little").view("<u8")[0]))
    return out


def wide_simhash(text: str | None, words_in_shingle: int, seed: int) -> list[int]:
    """Fingerprint of WIDE 64-bit words; like simhash(), each word from hashes mixed its own way. A set: repeated shingles count once."""
    return _wide_of(shingle_set(text, words_in_shingle, seed))


def bits_of_similarity(jaccard: float, slack: float = 2.5) -> int:
    """Differing bits of a wide fingerprint that sets of this Jaccard similarity and like size stay within, but for slack standard deviations."""
    share = float(np.arccos(2 * jaccard / (1 + jaccard)) / np.pi)
    n = 64 * WIDE
    return int(n * share + slack * np.sqrt(n * share * (1 - share)))


def recall(jaccard: float, similarity: float = 0.8) -> float:
    """Probability that two large sets of this Jaccard similarity and like size are proposed: within the cutoff and together in some table."""
    n, most = 64 * WIDE, bits_of_similarity(similarity, SLACK)
    share = acos(2 * jaccard / (1 + jaccard)) / pi
    met = lambda d: 1 - (1 - comb(n - d, SAMPLED) / comb(n, SAMPLED)) ** TABLES
    return sum(comb(n, d) * share**d * (1 - share) ** (n - d) * met(d) for d in range(most + 1))


def wide_fingerprint(text: Column, words_in_shingle: int = 5, seed: int = 42) -> Column:
    """struct(node, w0, w1, ...) of a text column; node is a hash of the set of shingles."""

    names = ["node", *[f"w{i}" for i in range(WIDE)]]

    def of(texts: list[str | None]) -> pa.Array:
        sets = (shingle_set(x, words_in_shingle, seed) for x in texts)
        found = np.array([[xxhash.xxh64_intdigest(h.tobytes(), seed), *_wide_of(h)] for h in sets], np.uint64).reshape(-1, 1 + WIDE).view(np.int64)
        return structs(**{c: pa.array(found[:, i]) for i, c in enumerate(names)})

    return of_texts(", ".join(f"{c} long" for c in names), of)(text)


def shingle_bytes(text: Column, words_in_shingle: int, seed: int) -> Column:
    """shingle_set() of a text column, 8 bytes a shingle."""

    def of(texts: list[str | None]) -> pa.Array:
        return pa.array([shingle_set(x, words_in_shingle, seed).tobytes() for x in texts], pa.binary())

    return of_texts("binary", of)(text)


def jaccard_roots(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """Root of each set's class, linked by a Jaccard similarity of this or more: breadth first, each set compared only with those of fitting size that no class has yet. No set is empty."""
    order = np.argsort([len(x) for x in sets], kind="stable")
    sizes = np.array([len(sets[i]) for i in order], np.int64)
    flat = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)[1]
    starts = np.cumsum(sizes) - sizes
    label, free, mark = np.arange(len(sets)), np.ones(len(sets), bool), np.zeros(int(flat.max()) + 1, np.int64)
    for seed in range(len(sets)):
        if not free[seed]:
            continue
        free[seed] = False
        frontier = [seed]
        while frontier:
            row = frontier.pop()
            low, high = np.searchsorted(sizes, similarity * sizes[row] - 1e-6), np.searchsorted(sizes, sizes[row] / similarity + 1e-6, "right")
            some = low + np.flatnonzero(free[low:high])
            if not len(some):
                continue
            own, n = flat[starts[row] : starts[row] + sizes[row]], sizes[some]
            begin = np.cumsum(n) - n
            mark[own] = 1
            common = np.add.reduceat(mark[flat[np.arange(n.sum()) + np.repeat(starts[some] - begin, n)]], begin)
            mark[own] = 0
            new = some[common / (sizes[row] + n - common) >= similarity]
            free[new] = False
            label[new] = seed
            frontier.extend(new.tolist())
    out = np.empty(len(sets), np.int64)
    out[order] = order[label]
    return out


def _set_stars(similarity: float):
    """Links of groups in rows (key, node, shingle bytes) sorted by key and node: (u, v), v the root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(group: dict[int, bytes]) -> Iterator[pa.RecordBatch]:
            own = {k: np.frombuffer(v, np.uint64) for k, v in group.items() if v}
            if len(own) > 1:
                nodes, roots = np.array(list(own), np.int64), jaccard_roots(list(own.values()), similarity)
                at = np.flatnonzero(roots != np.arange(len(roots)))
                if len(at):
                    yield pa.record_batch([pa.array(nodes[at]), pa.array(nodes[roots[at]])], names=["u", "v"])

        last, group = None, {}
        for batch in batches:
            for key, node, shingles in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if key != last:
                    yield from links(group)
                    last, group = key, {}
                group[node] = shingles
        yield from links(group)

    return run


def _table_keys(seed: int, tables: range):
    """Rows (node, known, w0, ...) to a row (key, node, known, w0, ...) for each of these tables: a key is the table's number and SAMPLED bits."""
    bits = [(t, random.Random(f"{seed}:{t}").sample(range(64 * WIDE), SAMPLED)) for t in tables]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [c.to_numpy().view(np.uint64) for c in batch.columns[2:]]
            for t, some in bits:
                key = np.full(batch.num_rows, t, np.int64)
                for b in some:
                    key = key << 1 | (words[b >> 6] >> np.uint64(b & 63) & _ONE).astype(np.int64)
                yield pa.record_batch([pa.array(key), *batch.columns], names=["key", *batch.schema.names])

    return run


def near_copy_classes(docs: DataFrame, id_col: str, text_col: str, words_in_shingle: int, seed: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    """(id, node) of each row, and (node, root, component_id) of each distinct set of shingles, for near copies of this similarity.

    Fingerprints propose groups, in two rounds of tables: members of a class of the first aren't linked
    again in the second, where a link joins classes. Within each group the shingle sets decide, so a link is a Jaccard
    similarity of this or more. The sets of groups move once, or once a tile where a group is large.
    """
    w = [f"w{i}" for i in range(WIDE)]
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("h", F.xxhash64(F.coalesce("text", F.lit(""))))
    prints = cut(texts.select("id", "h", wide_fingerprint(F.col("text"), words_in_shingle, seed).alias("f")).select("id", "h", "f.*"))
    files = files_for(prints.count())
    distinct = cut(prints.groupBy("node").agg(F.min("id").alias("least"), F.min(F.struct("h", "id")).alias("one"), *[F.first(c).alias(c) for c in w]), files)
    kind = "key long, node long, known long, " + ", ".join(f"{c} long" for c in w)

    def joined_in(rows: DataFrame, tables: range) -> DataFrame:
        """(known, root) of the known classes of rows (node, known, w0, ...) that these tables join."""
        buckets = _dealt(rows.mapInArrow(_table_keys(seed, tables), kind), "node")
        links = buckets.mapInArrow(_stars(bits_of_similarity(similarity, SLACK), wide=True), "u long, v long")
        return components(links).withColumnRenamed("node", "known")

    alone = distinct.select("node", F.col("node").alias("known"), *w)
    first = alone.join(joined_in(alone, range(FIRST)), "known", "left")
    known = cut(first.select("node", F.coalesce("root", "known").alias("known"), *w), files)
    rest = known.join(joined_in(known, range(FIRST, TABLES)), "known", "left")
    near = cut(rest.select("node", F.coalesce("root", "known").alias("root")).filter("node <> root"), files)
    groups = near.unionByName(near.select(F.col("root").alias("node"), "root").distinct())
    # One row of each set that has others near: by hash of the text and id, so that null ids are no hot key.
    one = distinct.join(groups, "node").select("node", F.col("root").alias("key"), F.col("one.h").alias("_h"), F.col("one.id").alias("_id"))
    found = texts.join(one, (texts["h"] == one["_h"]) & texts["id"].eqNullSafe(one["_id"]))
    sets = stored(found.select("key", "node", shingle_bytes(F.col("text"), words_in_shingle, seed).alias("shingles")), "shingles")
    links = _dealt(sets, "node", SET_TILE, F.octet_length("shingles") / 8).mapInArrow(_set_stars(similarity), "u long, v long")
    roots = components(links).withColumnRenamed("node", "linked")
    joined = distinct.join(roots, distinct["node"] == roots["linked"], "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    least = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.select("id", "node"), joined.select("node", "root").join(least, "root").select("node", "root", "component_id")


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_in_shingle: int = 5, seed: int = 42, similarity: float = 0.8) -> DataFrame:
    """docs with one row of each group of near copies: the one with the smallest id.

    A radius of 4 in 64 bits sees similarities from about 0.95; here fingerprints have 64 * WIDE bits.
    So many bits differ that pigeonhole buckets would hold everything, hence TABLES tables of SAMPLED
    bits bring texts together that may be near; there they are compared as bit planes, and the exact
    similarity of the shingle sets of those that are near decides. Texts without a
    word are one group.

    Of rows that share the smallest id one with the smallest hash of its shingles stays, whichever if
    that ties too. Where a group has null ids only, one of its rows stays. Columns are those of docs.
    """
    prints, classes = near_copy_classes(docs, id_col, text_col, words_in_shingle, seed, similarity)
    marked = prints.join(classes, "node")
    own = F.min(F.when(F.col("id").eqNullSafe(F.col("component_id")), F.col("node")))
    files = files_for(prints.count())
    keepers = cut(marked.groupBy("root", F.col("component_id").alias("_id")).agg(own.alias("_node")).select("_id", "_node"), files)
    rows = wrapped(docs, id=F.col(id_col), text=F.col(text_col))
    kept = rows.join(keepers, rows["id"].eqNullSafe(keepers["_id"]), "left_semi")
    # Ids that repeat are settled apart, so that no text is sorted for the others.
    twice = cut(rows.groupBy(F.col("id").alias("_twice")).count().filter("count > 1").select("_twice"), files)
    if twice.isEmpty():
        return kept.select("doc.*")
    once = kept.join(twice, kept["id"].eqNullSafe(twice["_twice"]), "left_anti")
    again = kept.join(twice, kept["id"].eqNullSafe(twice["_twice"]), "left_semi").withColumn("f", wide_fingerprint(F.col("text"), words_in_shingle, seed))
    again = again.withColumn("node", F.col("f.node"))
    chosen = again.join(keepers, again["id"].eqNullSafe(keepers["_id"]) & (again["node"] == keepers["_node"]), "left_semi")
    return once.select("doc").unionByName(chosen.dropDuplicates(["id", "node"]).select("doc")).select("doc.*")
