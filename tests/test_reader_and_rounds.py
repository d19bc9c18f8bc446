from pyspark.sql import functions as F

from broadsheet.operators import enrichment, issues, reader
from broadsheet.streaming import ingest


def test_articles_find_their_pages_by_stages(spark):
    pages = spark.createDataFrame([("i", 1, 1, "A1"), ("i", 2, 2, "A2"), ("i", 3, 3, None), ("j", 1, 1, "B1")], "issue string, pdf_page long, page_order long, label string")
    kind = "issue string, ordinal long, id string, page long, label string, source_pages array<long>"
    rows = [("i", 1, "a", 1, None, [2, 1]), ("i", 2, "b", 9, " a2 ", None), ("i", 3, "c", 0, "Z9", []), ("i", 4, "d", 3, "A1", None), ("i", 5, "e", None, None, None), ("k", 6, "f", 1, None, None)]
    got = {(r["issue"], r["pdf_page"]): (r["article_ids"], r["page_order"], r["is_fallback"]) for r in reader.page_articles(spark.createDataFrame(rows, kind), pages).collect()}
    assert got[("i", 1)][0] == ["a"] and got[("i", 2)][0] == ["a", "b"] and got[("i", 3)][0] == ["d"] and got[("j", 1)][0] == []
    assert got[("i", None)] == (["c", "e"], 4, True) and got[("k", None)] == (["f"], 1, True)


def test_unsupported_options_are_dropped_or_renamed():
    class Picky:
        def complete(self, task, payload):
            options = payload["options"]
            if "temperature" in options:
                raise ValueError("Unsupported parameter: temperature")
            if "max_tokens" in options:
                raise ValueError("max_tokens is not supported, use another")
            if payload.get("bad"):
                raise ValueError("no such model")
            return options

    client = enrichment.DowngradingClient(Picky(), {"temperature": 0.1, "max_tokens": 7, "seed": 1})
    assert client.complete("t", {}) == {"seed": 1, "max_completion_tokens": 7}
    try:
        client.complete("t", {"bad": True})
    except ValueError as e:
        assert "model" in str(e)
    else:
        raise AssertionError("an error of another kind goes on")


def test_whole_issues_and_ledger(spark):
    of = lambda rows: spark.createDataFrame(rows, "issue string, page long")
    all_ = spark.createDataFrame([("a", 2), ("b", 3), ("c", 1), ("d", 1)], "issue string, page_count long")
    done = of([("a", 1), ("a", 2), ("b", 1), ("c", 1), ("d", 1)])
    got = {r["issue"]: (r["complete"], r["reason"], r["pages"]) for r in issues.whole_issues(all_, of([("b", 1)]), of([("c", 1)]), done).collect()}
    assert got == {"a": (True, None, []), "b": (False, "failed", [1]), "c": (False, "pending", [1]), "d": (True, None, [])}
    ledger = spark.createDataFrame([("x", "k1", 1), ("y", "k2", 2)], "sha256 string, fingerprint_key string, processed_at int")
    assert [r["sha256"] for r in issues.ledger_of(ledger).collect()] == ["y", "x"] and issues.ledger_of(ledger, sha256="x", key="k2").count() == 0
    names = spark.createDataFrame([(["i1", "images/z.jpg", "i1", "no"], {"i1": "images/a.jpg"})], "i array<string>, m map<string,string>")
    assert names.select(issues.image_paths(F.col("i"), F.col("m"))).first()[0] == ["images/a.jpg", "images/z.jpg"]


def test_rounds_of_ingestion_and_of_retries(spark):
    seen, waits, configs = [], [], iter([{"n": 1, "poll_interval_seconds": 1}, {"n": 2, "poll_interval_seconds": 60}, {"n": 3}])
    assert ingest.poll(seen.append, lambda: next(configs), rounds=3, wait=waits.append) == 3
    assert [c["n"] for c in seen] == [1, 2, 3] and waits == [5.0, 60.0]
    waits, done = [], {}
    pending = spark.createDataFrame([(i, 0) for i in range(6)], "key int, tries int")
    attempt = lambda df: df.withColumn("tries", F.col("tries") + 1).withColumn("ok", F.col("key") < 2 * F.col("tries"))
    left = ingest.retry_rounds(pending, attempt, lambda df, n: done.update({n: sorted(r["key"] for r in df.collect())}), rounds=2, wait=waits.append)
    assert done == {1: [0, 1], 2: [2, 3]} and sorted(r["key"] for r in left.collect()) == [4, 5] and waits == [30, 90]
