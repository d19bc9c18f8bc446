import hashlib

from pyspark.sql import functions as F

from broadsheet.llm import queries as Q
from broadsheet.llm import syncmers as Y
from tests.llm.helpers import documents, empty


def brute_edits(rows):
    """(id, n, sha256 of the edited text) in order; rows sorted by id, equal rows follow each other."""
    out = []
    for i, (doc, text) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        q = len(text) // 4
        out.append((doc, len(text), hashlib.sha256((text[: len(text) - q] + nxt[:q]).encode()).hexdigest()))
    return out


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    found = Q.op7_closed_syncmers(spark, sf).collect()
    assert sorted((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found) == sorted(brute_edits(rows))
    texts, by = dict(rows), {r["doc_id"]: r for r in found}
    same = {}
    for r in found:
        assert same.setdefault(texts[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    ids = [d for d, _ in rows]
    for a, b in zip(ids, ids[1:] + ids[:1], strict=True):
        if by[a]["fingerprint"] == by[b]["fingerprint"]:
            assert by[a]["near_next"] == 1.0
    long = [r for r in found if r["n_chars"] > 600]
    assert sum(r["near_edited"] for r in long) / len(long) > 0.5 > 5 * sum(r["near_next"] for r in long) / len(long)


def test_odd_documents(spark):
    docs = documents(spark)
    found = Y.syncmer_report(docs).collect()
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))  # rows that share an id share a text here
    assert sorted(map(str, ((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found))) == sorted(map(str, brute_edits(rows)))
    assert Y.syncmer_report(empty(spark)).count() == 0
    one = Y.syncmer_report(docs.filter("doc_id = 8")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


def test_syncmers_are_closed_and_context_free(spark):
    text = " ".join(f"w{i * i % 97}x{i}" for i in range(200))
    df = spark.createDataFrame([(text,), ("zz " + text,), ("",), ("one two",)], "t string")
    a, b, none, few = (set(r["h"]) for r in df.select(Y.syncmer_hashes(F.col("t")).alias("h")).collect())
    assert len(a - b) <= 1 and len(b - a) <= 3 and none == set() and len(few) == 1
    # by the definition, from the pieces' window hashes as Spark gives them
    pieces = spark.createDataFrame([(text,)], "t string").select(F.regexp_extract_all("t", F.lit(Y.PIECE), F.lit(0)).alias("p")).first()["p"]
    inner = spark.createDataFrame([(i, *pieces[i : i + Y.S]) for i in range(len(pieces) - Y.S + 1)], "i int, a string, b string").select("i", F.xxhash64("a", "b").alias("h")).orderBy("i").collect()
    h = [r["h"] for r in inner]
    width = Y.K - Y.S
    starts = [i for i in range(len(h) - width) if min(h[i : i + width + 1]) in (h[i], h[i + width])]
    picked = spark.createDataFrame([(h[i], h[i + 2], h[i + 4]) for i in starts], "a long, b long, c long").select(F.shiftright(F.xxhash64("a", "b", "c"), 32).cast("int").alias("v"))
    assert {r["v"] for r in picked.collect()} == a


def test_main_path_is_native(spark):
    plan = Q.op7_closed_syncmers(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
