"""Queries whose work once grew faster than their input: the same results as plain code, at sizes the old plans took minutes for."""

import random
import re
import time
from collections import Counter
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from broadsheet.functions import text as X
from broadsheet.operators import folds, fuzzy, linking
from broadsheet.operators.likeness import Title, common_lengths, likest
from tests.conftest import values


def test_overlap_of_long_bodies(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choices("abcdefghij", k=4))
    bodies = [" ".join(word() for _ in range(15_000)) for _ in range(4)]
    rows = [("i", "k", n, b) for n, b in enumerate(bodies)] + [("i", "alone", 9, "x"), (None, "k", 1, "a b c c"), (None, "k", 2, None), (None, "k", 3, "c"), (None, "k", 4, ""), (None, "k", 5, "A"), (None, "k", 6, "a a b İ")]
    df = spark.createDataFrame(rows, "issue string, key string, ordinal long, body string").repartition(3)
    began = time.time()
    found = folds.overlaps_before(df, ["issue", "key"], ["ordinal"]).filter("overlap is not null")
    got = {(r["issue"], r["ordinal"]): r["overlap"] for r in found.collect()}
    assert time.time() - began < 60
    share = lambda a, b: sum(t in b for t in a) / len(a)
    long = {("i", n): share(bodies[n].split(), set(bodies[n - 1].split())) for n in (1, 2, 3)}
    # A body that is missing has no share in common and gives none to the next row.
    assert got == long | {(None, 2): 0.0, (None, 4): 0.0, (None, 5): 0.0, (None, 6): 0.5}


def test_containment_of_bags(spark):
    text = " ".join(f"w{i % 3000}" for i in range(6000))
    df = spark.createDataFrame([(text, text + " x"), ("", "a"), ("a a b", "a")], "a string, b string")
    assert values(df.select(F.round(X.containment(X.tokens(F.col("a")), X.tokens(F.col("b"))), 4))) == [(1.0,), (0.0,), (0.6667,)]


PARTS = ["the", "and", "ati", "on", "onha", "e", "re", "ing"]


def titles(rng, n, longest=25):
    """Titles of which some are altered copies of an earlier one."""
    out = []
    for _ in range(n):
        if out and rng.random() < 0.3:
            t = list(rng.choice(out[-30:]))
            for _ in range(int(len(t) * rng.random() * 0.4)):
                t[rng.randrange(len(t))] = rng.choice("abc de")
            out.append(" ".join("".join(t).split()) or "a")
        else:
            out.append(" ".join("".join(rng.choices(PARTS, k=rng.randint(1, 3))) for _ in range(rng.randint(1, longest))))
    return out


def score(a, b):
    x, y = set(a.split()), set(b.split())
    return round(max(SequenceMatcher(None, a, b).ratio(), len(x & y) / min(len(x), len(y))), 4)


def test_common_subsequences_side_by_side():
    rng = random.Random(2)

    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
            row = new
        return row[-1]

    names = [*titles(rng, 12), "", "a"]
    for key in [*titles(rng, 6), "a", "zz"]:
        assert common_lengths(key, [Title(t) for t in names]) == [plain(key, t) for t in names]


def test_bound_spares_most_ratios(monkeypatch):
    rng = random.Random(3)
    made = []
    ratio = Title.ratio
    monkeypatch.setattr(Title, "ratio", lambda self, key: made.append(key) or ratio(self, key))
    names = [" ".join("".join(rng.choices("etaoinshrdlu", k=5)) for _ in range(20)) for _ in range(60)]
    for at in range(20, 60):
        assert likest(names[at], [Title(t) for t in names[at - 20 : at]], 0.72) == []
    # Of 800 pairs of like length, each of which had its ratio worked out before.
    assert len(made) < 8


def test_fuzzy_continuations_across_runs(spark):
    rng = random.Random(4)
    rows = [("one", 3 * n, t) for n, t in enumerate(titles(rng, 600))] + [("two", n, t) for n, t in enumerate(titles(rng, 30, 60))] + [("two", 100, "?"), (None, 1, "a title here"), (None, 2, "a title here")]
    df = spark.createDataFrame(rows, "issue string, ordinal long, title string").repartition(3)
    expected = {}
    for issue in ("one", "two", None):
        seen = [(n, t) for i, n, t in sorted(rows, key=lambda r: r[1]) if i == issue and t != "?"]
        for at, (n, t) in enumerate(seen):
            found = [(-score(t, o), m) for m, o in seen[max(0, at - 20) : at]]
            if found and min(found)[0] <= -0.72:
                expected[issue, n] = (min(found)[1], -min(found)[0])
    assert {(r["issue"], r["ordinal"]): (r["target"], r["score"]) for r in fuzzy.fuzzy_continuations(df).collect()} == expected
    assert any(issue == "one" and n // 3 % 256 < 20 and n >= 768 for issue, n in expected)


def test_outside_directory_in_both_ways(spark, monkeypatch):
    rng = random.Random(5)
    words = [f"w{c}" for c in "abcdefghijkl"] + ["it's", "co-op", "I", "B7"]
    text = lambda n: " ".join(rng.choices(words, k=n))
    items = [(n, text(rng.randint(2, 12))) for n in range(30)] + [(1, "wa wa wa wa wb"), (98, None), (99, "")]
    rows = [(n, text(rng.randint(1, 40)) + " other" * rng.randint(0, 60)) for n in range(300)]
    rows += [(1000, None), (1001, ""), (1002, "wa WA A12 wa A123 wa wb"), (1003, "wa wb x y z q r s")]
    bag = lambda t: Counter(re.findall("[a-z0-9]+(?:['-][a-z0-9]+)?", re.sub("(?i)(?<![A-Z0-9])[A-Z][0-9]{1,3}(?![A-Z0-9])", " ", t or "").lower()))
    bags = [b for _, t in items if (b := bag(t)).total() >= 4]
    directory = sum(bags, Counter())
    dropped = {n for n, t in rows if (b := bag(t)).total() >= 4 and (b & directory).total() / b.total() >= 0.3 and any((b & i).total() / i.total() >= 0.6 for i in bags)}
    articles, listed = spark.createDataFrame(rows, "ordinal long, body string"), spark.createDataFrame(items, "item_id long, text string")
    found = linking.outside_directory(articles, listed, coverage=0.3)
    assert 50 < len(dropped) < 250
    assert [n for (n,) in values(found.select("ordinal"), "ordinal")] == sorted({n for n, _ in rows} - dropped)
    # Tokens of articles are neither joined nor moved: no task holds more than an article's counts.
    assert "token" not in found._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(linking, "DIRECTORY_ROWS", 10)
    by_joins = linking.outside_directory(articles, listed, coverage=0.3)
    assert "token" in by_joins._jdf.queryExecution().executedPlan().toString()
    assert values(by_joins, "ordinal") == values(found, "ordinal")


def test_outside_directory_of_repeated_ordinals(spark):
    listed = spark.createDataFrame([(1, "a b c d e")], "item_id long, text string")
    # Both rows of an ordinal have as many tokens, so they count as one text: 5 of 20, not 10 of 20.
    part = "a b c d e" + " x" * 11
    articles = spark.createDataFrame([(1, part), (1, part), (2, part), (3, "a b c x")], "ordinal long, body string")
    found = linking.outside_directory(articles, listed, coverage=0.5)
    assert values(found.select("ordinal"), "ordinal") == [(1,), (1,), (2,)]
