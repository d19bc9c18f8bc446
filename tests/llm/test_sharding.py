from collections import Counter, defaultdict

from pyspark.sql import functions as F

from broadsheet.llm import queries as Q
from broadsheet.llm.sharding import rendezvous_shards, shard_slots
from tests.llm.helpers import documents, empty


def test_growth_moves_rows_only_into_the_new_shard(spark):
    rows = rendezvous_shards(spark.range(20_000).withColumnRenamed("id", "k"), "k", [1.0] * 16, grown="g").collect()
    assert all(r["g"] in (r["shard"], 16) for r in rows)
    moved = sum(r["g"] == 16 for r in rows)
    assert abs(moved - 20_000 / 17) < 200
    assert max(Counter(r["shard"] for r in rows).values()) < 1.15 * 20_000 / 16


def test_weights_and_many_shards(spark):
    rows = spark.range(30_000).withColumnRenamed("id", "k")
    count = Counter(r["shard"] for r in rendezvous_shards(rows, "k", [1, 2, 0, 3]).collect())
    assert count[2] == 0 and abs(count[3] - 15_000) < 600 and abs(count[1] - 10_000) < 600
    few = rendezvous_shards(rows, "k", [1.0] * 64)
    # one more than the unrolled form holds: the array form must agree with it but for moves into the new shard
    many = rendezvous_shards(rows, "k", [1.0] * 65).select("k", F.col("shard").alias("m"))
    assert few.join(many, "k").filter("m <> shard and m <> 64").count() == 0


def test_slots_are_gapless_however_small_the_runs(spark):
    docs = rendezvous_shards(documents(spark, 300), "doc_id", [1.0] * 3)
    for run in (1, 7, 50_000):
        out = shard_slots(docs, "shard", ["doc_id"], rows_per_run=run)
        assert out.columns == docs.drop("slot").columns + ["slot"]
        places = defaultdict(list)
        for r in out.collect():
            places[r["shard"]].append(r["slot"])
        assert all(sorted(v) == list(range(len(v))) for v in places.values())
        assert sum(map(len, places.values())) == 302
    assert shard_slots(rendezvous_shards(empty(spark), "doc_id", [1.0] * 3), "shard", ["doc_id"]).count() == 0


def test_query(spark):
    import zlib

    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = Q.op1_rendezvous_shards(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(data) + 1, zlib.crc32(data), "key")
