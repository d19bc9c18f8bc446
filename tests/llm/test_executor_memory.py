"""What holds executors' memory that no task needs: workers that work a column out again, other daemons, a process for each file."""

import pytest
from pyspark import SparkContext

from broadsheet.llm import common, quality
from broadsheet.llm import simhash as S
from broadsheet.llm.langid import train
from tests.llm.helpers import documents


def test_statistics_are_worked_out_once(spark, monkeypatch):
    plans, stored = [], quality.stored
    monkeypatch.setattr(quality, "stored", lambda df, *a, **b: plans.append(df._jdf.queryExecution().executedPlan().toString()) or stored(df, *a, **b))
    docs = documents(spark)
    kept = {r["doc_id"] for r in quality.quality_report(docs).collect() if r["kept"]}
    report = len(plans)
    assert {r["doc_id"] for r in quality.quality_filter(docs).collect()} == kept
    assert [plans[i].count("ArrowEvalPython") for i in (0, report)] == [1, 1]


def test_training_has_no_rows_in_workers_of_another_daemon(spark, monkeypatch):
    docs = documents(spark)
    want = train(docs).languages
    monkeypatch.setattr(SparkContext, "parallelize", lambda *a, **b: pytest.fail("a list's rows go through Python workers"))
    assert train(docs).languages == want == ["de", "en", "fr"]


def test_rounds_of_few_links_are_few_files(spark, monkeypatch):
    files = []

    def cut(df, *a):
        out = common.cut(df, *a)
        files.append(out._jdf.rdd().getNumPartitions())
        return out

    monkeypatch.setattr(S, "cut", cut)
    links = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 101)], "u long, v long")
    held = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        found = sorted((r["node"], r["root"]) for r in S.components(links).collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found == [*((i, 0) for i in range(1, 51)), (101, 100)]
    assert len(files) > 2 and max(files[1:]) < 20
