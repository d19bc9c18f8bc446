import zlib

import numpy as np

from broadsheet.llm import langid as L
from broadsheet.llm import queries as Q
from tests.llm.helpers import documents, empty


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: (r["lang"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = Q.op8_kernel_language_id(spark, sf).collect()
    assert len(found) == len(truth)
    right = total = 0
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1
        lang, text = truth[r["doc_id"]]
        if r["held_out"] and lang and text:
            total += 1
            right += r["lang_pred"] == lang
    assert right / total > 0.95


def test_kernel_of_the_model_is_the_blended_spectrum_kernel():
    texts = ["the cat sat on the mat", "der hund und die katze", "the dog and the cat", "die maus und der hund", "hat the cat the mat", "und der die das"]
    langs = ["en", "de", "en", "de", "en", "de"]
    model = L.fit(texts, langs)
    sets = [L.grams(t) for t in texts]
    kernel = np.array([[np.mean([len(np.intersect1d(a, b)) / np.sqrt(len(a) * len(b)) for a, b in zip(x, y, strict=True)]) for y in sets] for x in sets])
    values, vectors = np.linalg.eigh(kernel)
    keep = values > 1e-6 * values[-1]
    features = vectors[:, keep] * np.sqrt(values[keep])
    target = np.array([[1, -1] if y == "de" else [-1, 1] for y in langs], float)
    ridge = np.linalg.solve(features.T @ features / 3 + L.RIDGE * np.eye(keep.sum()) / 6, features.T @ target / 3)
    assert np.allclose(model.scores(texts), features @ ridge, atol=1e-3)
    assert [p for p, _ in model.predict(["the hat", None, "12 !", ""])] == ["en", "und", "und", "und"]


def test_odd_documents(spark):
    docs = documents(spark, 200)
    found = L.language_report(docs).collect()
    assert len(found) == docs.count()
    by = {str(r["doc_id"]): r for r in found}
    assert by["3"]["lang_pred"] == by["4"]["lang_pred"] == by["10"]["lang_pred"] == "und" and by["3"]["score"] == 0.0
    assert by["9"]["lang_pred"] != "und"
    again = {str(r["doc_id"]): tuple(r) for r in L.language_report(docs.repartition(5)).collect()}
    assert all(again[k][:3] == tuple(r)[:3] and abs(again[k][3] - r["score"]) < 1e-6 for k, r in by.items())
    assert L.language_report(empty(spark)).count() == 0
    unlabelled = docs.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {(r["lang_pred"], r["score"]) for r in L.language_report(unlabelled).collect()} == {("und", 0.0)}


def test_prediction_reads_the_text_alone(spark):
    docs = documents(spark, 200)
    model = L.train(docs)
    a = [r["p"] for r in docs.select(L.predicted(docs, model, docs["text"]).alias("p")).collect()]
    other = docs.selectExpr("text", "doc_id + 5 as doc_id", "'xx' as lang", "'y' as source")
    b = [r["p"] for r in other.select(L.predicted(other, model, other["text"]).alias("p")).collect()]
    assert a == b
