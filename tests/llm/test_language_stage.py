import pytest

import corpus_pipeline as P

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("unlearned", ["de", "es", "fr"])
def test_texts_in_an_unlearned_language_are_dropped_and_clean_ones_kept(spark, unlearned):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("lang is not null and n_chars > 200")
    hidden = docs.selectExpr("doc_id", "text", f"nullif(lang, '{unlearned}') as lang", "source", "n_chars")
    count = lambda df: {r["k"]: r["count"] for r in df.groupBy((df["lang"].isNull()).alias("k")).count().collect()}
    given, kept = count(hidden), count(P.language(spark, hidden, SF))
    assert kept.get(True, 0) <= 0.05 * given[True] and kept[False] >= 0.99 * given[False]
