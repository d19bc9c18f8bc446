from collections import defaultdict

from pyspark.sql import functions as F

from broadsheet.llm import syncmers as Y


def found(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", Y.anchors(F.col("t")).alias("a")).orderBy("i").collect()
    return [[(x["at"], x["h"]) for x in r["a"]] for r in rows]


def test_every_anchor_has_its_position_and_long_texts_keep_all(spark):
    text = " ".join(f"w{i * i % 9973}x{i}" for i in range(6000))
    inner = " ".join(f"w{i * i % 9973}x{i}" for i in range(5000, 5060))  # 60 words far inside
    a, b = found(spark, [text, inner])
    assert len(a) > 2000 and [p for p, _ in a] == sorted({p for p, _ in a})
    at = {h: p for p, h in a}
    shifts = {at[h] - p for p, h in b}
    assert len(b) > 30 and len(shifts) == 1


def test_a_passage_in_unspaced_text_keeps_its_anchors_when_shifted(spark):
    passage = "".join(chr(0x4E00 + i * i * 7919 % 20000) for i in range(300))
    plain, *moved = found(spark, [passage, *["語" * n + passage for n in (1, 2, 3, 4)]])
    assert len(plain) > 60
    for n, other in enumerate(moved, 1):
        assert {(p + n, h) for p, h in plain} <= set(other)


def test_matches_pair_the_nth_anchor_with_the_nth(spark):
    texts = [" ".join(f"w{i % 40}q" for i in range(200)), "zz yy xx " + " ".join(f"w{i % 40}q" for i in range(120)), "", "abc"]
    by = found(spark, texts)
    pairs = [(i, j) for i in range(4) for j in range(4)]
    df = spark.createDataFrame([(i, j, texts[i], texts[j]) for i, j in pairs], "i int, j int, a string, b string")
    for r in df.select("i", "j", Y.matches(Y.anchors(F.col("a")), Y.anchors(F.col("b"))).alias("m")).collect():
        one, two = defaultdict(list), defaultdict(list)
        for p, h in by[r["i"]]:
            one[h].append(p)
        for p, h in by[r["j"]]:
            two[h].append(p)
        assert [tuple(x) for x in r["m"]] == sorted(x for h in one for x in zip(one[h], two[h], strict=False))
