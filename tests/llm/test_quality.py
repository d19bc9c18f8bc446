import random
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from broadsheet.llm import quality as U
from broadsheet.llm import queries as Q
from broadsheet.llm.textstats import repeated_words, text_stats
from tests.llm.helpers import documents, empty, words


def brute(text):
    text = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(found[i : i + 8]) for i in range(len(found) - 7)]
    many = Counter(windows)
    covered = {j for i, w in enumerate(windows) if many[w] > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "é#", "c|", "\x85", " "]), max_size=60), st.sampled_from([" ", "\n", "\t \n"]))
def test_statistics_equal_brute_force(parts, joint):
    text = joint.join(parts)
    assert text_stats(text)[:5] == brute(text)


def test_repeats():
    assert repeated_words([b"a"] * 9) == 9 and repeated_words([b"a"] * 8) == 0
    assert text_stats(None) == (0,) * 7


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = Q.op10_robust_quality(spark, sf).collect()
    assert len(found) == len(texts)
    labels = {r["doc_id"]: (r["quality"], r["toxic"]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    clean = dropped = 0
    for r in found:
        base = brute(texts[r["doc_id"]])
        assert tuple(r)[1:6] == base
        assert r["base_failed"] == (base[0] < 20 or 100 * base[4] > 30 * base[0])
        assert not (r["base_failed"] and r["kept"])
        if not r["base_failed"] and labels.get(r["doc_id"], (0, 0))[0] == 1:
            clean += 1
            dropped += not r["kept"]
    junk = [r for r in found if not r["base_failed"] and r["n_symbols"] > 0.1 * r["word_chars"]]
    assert len(junk) > 10 and not any(r["kept"] for r in junk)
    assert dropped <= 0.005 * clean


def test_estimate_resists_a_fifth_of_junk(spark):
    rng = random.Random(2)
    rows = [(i, words(rng, "en", rng.randint(60, 400)), "en", "a") for i in range(500)]
    rows += [(1000 + i, " ".join(w + "***" for w in words(rng, "en", 80).split()), "en", "a") for i in range(120)]
    found = U.quality_report(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert all(r["kept"] == (r["doc_id"] < 1000) for r in found)


def test_one_step_equals_numpy(spark):
    rng = np.random.default_rng(0)
    x = np.rint(rng.normal(size=(400, U.DIMS)) * 700).astype(int)
    rows = spark.createDataFrame([("g", *map(int, r)) for r in x], "g string, " + ", ".join(f"{c} long" for c in U.X))
    start = U._start(rows)
    params = np.array(start.first()["params"])
    mean, inverse = params[: U.DIMS], params[U.DIMS :].reshape(U.DIMS, U.DIMS)
    d = np.einsum("ni,ij,nj->n", x / U.SCALE - mean, inverse, x / U.SCALE - mean)
    bins = np.floor(U.FINE * np.log2(np.maximum(d, 1e-6)))
    near = x[bins <= np.sort(bins)[int(np.ceil(U.SHARE * 400)) - 1]] / U.SCALE
    cov = np.cov(near.T, bias=True) * U.SHARE / U.INNER_SHARE
    cov += np.diag(np.maximum(0, np.array(U.FLOORS) ** 2 - np.diag(cov)))
    got = np.array(U._step(rows, start).first()["params"])
    assert np.allclose(got[: U.DIMS], near.mean(axis=0)) and np.allclose(got[U.DIMS :].reshape(U.DIMS, U.DIMS), np.linalg.inv(cov))


def test_odd_documents_and_filter(spark):
    docs = documents(spark, 300)
    report = U.quality_report(docs).collect()
    assert len(report) == docs.count()
    by = {str(r["doc_id"]): r for r in report}
    assert by["3"]["n_words"] == 0 and by["3"]["base_failed"] and by["8"]["n_words"] == 9000
    kept = U.quality_filter(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["doc_id"]) for r in report if r["kept"])
    assert U.quality_report(empty(spark)).count() == 0 and U.quality_filter(empty(spark)).count() == 0
