from collections import Counter

import corpus_pipeline as P
from broadsheet.llm.langid import train
from broadsheet.llm.quality import quality_report
from tests.llm.helpers import documents, empty
from tests.llm.test_simhash import brute_near

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    steps = []
    for name, stage in P.STAGES:
        out = str(tmp_path / name)
        stage(spark, docs, SF).write.parquet(out)
        after = spark.read.parquet(out)
        steps.append((name, docs, after))
        if name != "packing":
            assert after.columns == columns
        docs = after
    (_, raw, good), (_, _, told), (_, _, single), (_, _, mixed), (_, _, packed) = steps
    ids = lambda df: sorted(r["doc_id"] for r in df.collect())
    assert ids(good) == sorted(r["doc_id"] for r in quality_report(raw).collect() if r["kept"])
    model = train(good)
    rows = good.collect()
    pred = model.predict([r["text"] for r in rows])
    assert ids(told) == sorted(r["doc_id"] for r, (lang, score) in zip(rows, pred, strict=True) if lang != "und" and score >= 0.3)
    assert ids(single) == sorted(set(brute_near(told.collect())))
    assert set(ids(mixed)) == set(ids(single)) and max(Counter(ids(mixed)).values()) <= 3
    assert set(r["doc_id"] for r in packed.collect()) == set(ids(mixed))
    pieces = Counter()
    for r in packed.collect():
        pieces[r["doc_id"]] += r["length"]
    total = {r["doc_id"]: r["doc_tokens"] for r in packed.collect()}
    uses = Counter(ids(mixed))
    assert all(pieces[d] == uses[d] * total[d] for d in uses)
    assert P.run(spark, SF).count() == packed.count()


def test_odd_and_empty_tables(spark, tmp_path):
    for name, docs in (("odd", documents(spark, 120)), ("empty", empty(spark))):
        for step, stage in P.STAGES:
            out = str(tmp_path / name / step)
            stage(spark, docs, SF).write.parquet(out)
            docs = spark.read.parquet(out)
        assert (docs.count() > 0) == (name == "odd")
