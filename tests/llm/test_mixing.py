import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from broadsheet.llm import mixing as M
from broadsheet.llm import queries as Q
from tests.compare import duck, rows
from tests.llm.helpers import documents, empty


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert rows(Q.op5_temperature_mixture(spark, sf).toPandas()) == rows(duck(sf).execute(Q.OP5_SQL).df())


def _entropy(parts):
    total = sum(parts)
    return -sum(p / total * math.log(p / total) for p in parts)


@pytest.mark.parametrize("share", [0.5, 0.9, 0.999, 1.0])
def test_entropy_is_met(spark, share):
    sizes = [1_000_000, 200_000, 5_000, 40, 40]
    df = spark.createDataFrame([(str(i), n) for i, n in enumerate(sizes)], "source string, tokens long")
    found = M.source_weights(df, target_entropy=share).collect()
    plain = _entropy(sizes) / math.log(5)
    reached = _entropy([r["parts"] for r in found]) / math.log(5)
    assert abs(reached - max(share, plain)) < 2e-4
    assert all(r["quota"] >= r["tokens"] for r in found)


def test_repetition_limit(spark):
    df = spark.createDataFrame([("a", 1_000_000), ("b", 1000), ("c", 10)], "source string, tokens long")
    for limit in (1.0, 3.0, 1e9):
        found = {r["source"]: r for r in M.source_weights(df, repetition_limit=limit).collect()}
        use = {k: r["quota"] / r["tokens"] for k, r in found.items()}
        assert use["c"] <= limit * 1.15 + 0.1 and 0.99 < use["a"] < 1.15
    with pytest.raises(ValueError):
        M.source_weights(df)
    assert M.source_weights(df.limit(0), target_entropy=0.5).count() == 0


def test_one_source_and_a_null_one(spark):
    df = spark.createDataFrame([(None, 7)], "source string, tokens long")
    row = M.source_weights(df, target_entropy=1.0, repetition_limit=2.0).first()
    assert (row["parts"], row["budget"], row["quota"]) == (1_000_000, 7, 7)


def test_streams_and_blocks_against_brute_force(spark):
    docs = documents(spark)
    tokens = F.length(F.coalesce("text", F.lit("")))
    for run in (3, 50_000):
        placed = M.streams(M.keyed(docs, tokens, "doc_id", "source", "s:"), rows_per_run=run).collect()
        by = defaultdict(list)
        for r in placed:
            by[r["source"]].append(r)
        for group in by.values():
            at = 0
            for r in sorted(group, key=lambda r: r["before"]):
                assert r["before"] == at
                at += r["tokens"]
            assert [r["key"] for r in sorted(group, key=lambda r: r["before"])] == sorted(r["key"] for r in group)
    out = M.mixture(docs, tokens, 5000, target_entropy=1.0, repetition_limit=2.0)
    used = out.groupBy("source").agg(F.sum("tokens").alias("t"), F.first("quota").alias("q"), F.max("tokens").alias("m")).collect()
    assert all(r["q"] <= r["t"] < r["q"] + r["m"] for r in used)
    assert {str(r["doc_id"]) for r in out.collect()} == {str(r["doc_id"]) for r in docs.collect()}


def test_mix_keeps_every_row_and_columns(spark):
    docs = documents(spark)
    tokens = F.length(F.coalesce("text", F.lit("")))
    out = M.mix(docs, tokens, target_entropy=1.0, repetition_limit=3.0)
    assert out.columns == docs.columns
    uses = Counter(str(r["doc_id"]) for r in out.collect())
    expected = Counter(str(r["doc_id"]) for r in M.mixture(docs, tokens, 5000, target_entropy=1.0, repetition_limit=3.0).collect())
    single = [k for k, v in Counter(str(r["doc_id"]) for r in docs.collect()).items() if v == 1]
    assert all(uses[k] == expected[k] for k in single) and max(uses.values()) > 1
    assert M.mix(empty(spark), tokens, target_entropy=1.0).count() == 0
    assert M.mixture(empty(spark), tokens, 100, target_entropy=1.0).count() == 0
