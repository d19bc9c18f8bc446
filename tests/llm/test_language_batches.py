import random

import numpy as np
import pytest

from broadsheet.llm import langid as L
from broadsheet.llm import queries as Q
from tests.llm.helpers import LANGS, words


def model(languages):
    rng = random.Random(3)
    rows = [(words(rng, x, 60), x) for _ in range(30) for x in languages]
    return L.fit(*map(list, zip(*rows, strict=True)))


@pytest.mark.parametrize("text", ["½ ² ³ ¼", "Ⅷ ⅳ", "① ② ⓩ"[:3], "12 _ -", "́ं"])
def test_texts_without_a_letter_are_unknown(text):
    m = model(sorted(LANGS))
    assert m.predict([text]) == [("und", 0.0)] and m.decisions([text])[0] == -np.inf


@pytest.mark.parametrize("text", ["a", "ª", "日", "ʰ", "ǅ", "1 ж 2"])
def test_a_code_point_of_category_l_is_a_letter(text):
    assert model(sorted(LANGS)).predict([text])[0][0] in LANGS


def test_a_batch_equals_its_texts_one_by_one(monkeypatch):
    m, rng = model(sorted(LANGS)), random.Random(5)
    texts = [words(rng, rng.choice(sorted(LANGS)), rng.randint(0, 300)) for _ in range(80)] + ["", "a", "語"]
    single = np.concatenate([m.scores([t]) for t in texts])
    for product in (1 << 22, 5000, 1):
        monkeypatch.setattr(L, "PRODUCT", product)
        assert np.allclose(m.scores(texts), single, atol=1e-5)
    assert m.scores([]).shape == (0, len(LANGS))


def test_every_language_has_landmarks():
    names = [f"l{i:03d}" for i in range(130)]
    texts = [" ".join(f"{chr(0x4E00 + 40 * i + j)}{chr(0x4E00 + 40 * i + k)}" for k in range(8)) for i in range(130) for j in range(3)]
    m = L.fit(texts, [n for n in names for _ in range(3)])
    assert [p for p, _ in m.predict(texts)] == [n for n in names for _ in range(3)]


def test_query_equals_a_dense_version_from_the_same_rows(spark):
    """Kernel by kernel: presence vectors, landmarks, ridge and scores without any sparse or folded product."""
    import hashlib
    import zlib

    sf = "/root/testdata/sf0.001"
    docs = [r.asDict() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    own = {}
    for d in docs:
        if d["lang"] is not None and d["text"] and L._LETTER.search(d["text"]) and zlib.crc32(str(d["doc_id"]).encode()) % 5:
            own.setdefault(d["lang"], []).append((hashlib.md5(str(d["doc_id"]).encode()).hexdigest(), d["text"]))
    names = sorted(own)
    taken = [(lang, t) for lang in names for _, t in sorted(own[lang])[: L.SAMPLE]]
    dense = lambda t: [np.bincount(g, minlength=1 << L.BITS)[: 1 << L.BITS].astype(float) / np.sqrt(max(len(g), 1)) for g in L.grams(t)]
    sets = [np.concatenate(dense(t)) / 2 for _, t in taken]  # 1/2 * 1/2: a mean over the four n
    marks = [i for lang in names for i in [j for j, (y, _) in enumerate(taken) if y == lang][: L.LANDMARKS]]
    land = np.array([sets[i] for i in marks])
    kernel = np.array(sets) @ land.T
    values, vectors = np.linalg.eigh(kernel[marks])
    keep = values > 1e-6 * values[-1]
    root = vectors[:, keep] / np.sqrt(values[keep])
    features = kernel @ root
    labels = [lang for lang, _ in taken]
    target = np.where(np.array(labels)[:, None] == np.array(names), 1.0, -1.0)
    weight = np.array([1 / labels.count(y) for y in labels])[:, None]
    ridge = np.linalg.solve(features.T @ (weight * features) + L.RIDGE * np.eye(features.shape[1]) / len(taken), features.T @ (weight * target))
    got = {r["doc_id"]: r for r in Q.op8_kernel_language_id(spark, sf).collect()}
    for d in docs:
        if not d["text"] or not L._LETTER.search(d["text"]):
            assert (got[d["doc_id"]]["lang_pred"], got[d["doc_id"]]["score"]) == ("und", 0.0)
            continue
        s = (np.concatenate(dense(d["text"])) / 2) @ land.T @ root @ ridge
        e = np.exp(4 * (s - s.max()))
        assert got[d["doc_id"]]["score"] == pytest.approx(1 / e.sum(), abs=2e-3)
        if np.sort(s)[-1] - np.sort(s)[-2] > 1e-3:
            assert got[d["doc_id"]]["lang_pred"] == names[int(s.argmax())]
