"""The near-copy stage against all pairs of shingle sets: five words, a Jaccard similarity of 0.8 or more, the smallest id of each group."""

import re
from itertools import combinations

import corpus_pipeline as P

SF = "/root/testdata/sf0.01"


def test_the_stage_keeps_the_smallest_id_of_each_group_of_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sets, empty = {}, []
    for r in docs.collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or ""))
        if words:
            sets[r["doc_id"]] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}
        else:
            empty.append(r["doc_id"])
    least = {i: i for i in sets}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    links = 0
    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if min(len(x), len(y)) < 0.8 * max(len(x), len(y)):
            continue
        both = len(x & y)
        if both >= 0.8 * (len(x) + len(y) - both):
            links += 1
            a, b = sorted((root(a), root(b)))
            least[b] = a
    assert links > 20
    expected = {i for i in sets if root(i) == i} | set(sorted(empty)[:1])
    assert {r["doc_id"] for r in P.near_copies(spark, docs, SF).collect()} == expected
