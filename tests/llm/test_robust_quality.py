"""Verdicts of op10 row by row against a separate implementation in NumPy."""

import re
from collections import Counter

import numpy as np
import pytest

from broadsheet.llm import quality as U
from broadsheet.llm import queries as Q

FLOORS = np.array(U.FLOORS)


def statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, chars = len(words), sum(map(len, words))
    if n < 20 or 100 * len(covered) > 30 * n:
        return None
    x = [np.log(n), np.log(chars / n), np.sqrt(len(re.findall(r"[#*$%&|<>]", text)) / chars), np.log(len(set(words))) / np.log(n + 1), np.sqrt((len(lines) - len(set(lines))) / len(lines)), np.sqrt(len(covered) / n)]
    return np.floor(512 * np.array(x) + 0.5)


def floored(cov):
    cov = cov + np.diag(np.maximum(0, FLOORS**2 - np.diag(cov)))
    values, vectors = np.linalg.eigh(cov / np.outer(FLOORS, FLOORS))
    return vectors @ np.diag(np.maximum(values, U.LEAST_EIGENVALUE)) @ vectors.T * np.outer(FLOORS, FLOORS)


def step(x, centre, cov):
    off = x / 512 - centre
    bins = np.floor(U.FINE * np.log2(np.maximum(np.einsum("ni,ij,nj->n", off, np.linalg.inv(cov), off), 1e-6)))
    near = x[bins <= np.sort(bins)[int(np.ceil(0.75 * len(x))) - 1]] / 512
    return near.mean(axis=0), floored(np.cov(near.T, bias=True).reshape(6, 6) * 0.75 / U.INNER_SHARE)


def mcd(x):
    """Three deterministic starts, two steps each, then the least determinant until it falls no more."""
    low, median, high = (np.sort(x, axis=0)[max(0, int(np.ceil(q * len(x))) - 1)] / 512 for q in (0.25, 0.5, 0.75))
    scale = np.maximum((high - low) / 1.349, FLOORS)
    z = (x / 512 - median) / scale
    found = [(median, np.diag(scale**2))]
    for y in (np.tanh(z), z / np.maximum(np.linalg.norm(z, axis=1), 1e-9)[:, None]):
        c = np.cov(np.rint(4096 * y).T, bias=True)
        deviation = np.sqrt(np.maximum(np.diag(c), 1))
        shape = c / np.outer(deviation, deviation)
        np.fill_diagonal(shape, 1)
        found.append((median, floored(shape * np.outer(scale, scale))))
    for _ in range(2):
        found = [step(x, *f) for f in found]
    best = min(found, key=lambda f: np.linalg.slogdet(f[1])[1])
    while True:
        after = step(x, *best)
        if np.linalg.slogdet(after[1])[1] >= np.linalg.slogdet(best[1])[1] - U.LEAST_FALL:
            return best
        best = after


def mixed(w, inner, outer, apart):
    way = inner[0] - outer[0]
    return w * inner[0] + (1 - w) * outer[0], w * inner[1] + (1 - w) * outer[1] + apart * w * (1 - w) * np.outer(way, way)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_every_verdict_equals_brute_force(spark, sf):
    rows = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text", "lang", "source").collect()
    x = {r["doc_id"]: v for r in rows if (v := statistics(r["text"] or "")) is not None}
    groups: dict[tuple, list[int]] = {}
    for r in rows:
        if r["doc_id"] in x:
            for key in ((), (r["lang"],), (r["lang"], r["source"])):
                groups.setdefault(key, []).append(r["doc_id"])
    est = {k: mcd(np.array([x[i] for i in ids])) for k, ids in groups.items()}
    n_all = len(groups[()])
    if sf == "sf0.1":
        assert max(len(v) for k, v in groups.items() if len(k) == 2) > 200
    kept = {}
    for (lang, source), ids in ((k, v) for k, v in groups.items() if len(k) == 2):
        n = len(groups[(lang,)])
        outer = mixed(n / (n + 25), est[(lang,)], (est[()][0], est[()][1] * (1 + 25 / n_all)), 1)
        centre, cov = mixed(len(ids) / (len(ids) + 100), est[(lang, source)], outer, 0)
        for i in ids:
            off = x[i] / 512 - centre
            kept[i] = (off @ np.linalg.inv(cov) @ off, )
    got = {r["doc_id"]: r for r in Q.op10_robust_quality(spark, f"/root/testdata/{sf}").collect()}
    assert len(got) == len(rows) and {i for i, r in got.items() if not r["base_failed"]} == set(kept)
    for i, (d,) in kept.items():
        assert got[i]["distance"] == pytest.approx(d, rel=1e-4, abs=1e-3)
        assert got[i]["kept"] == (d <= U.CUTOFF)
    assert not any(r["kept"] for r in got.values() if r["base_failed"])
