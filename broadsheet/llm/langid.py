"""Language identification by string kernels.

The kernel of two texts is the blended spectrum presence kernel: over n = 1 to 4, the number of
n-grams that both contain, scaled by the numbers each contains, and averaged. Landmarks give its
Nyström feature map; kernel ridge regression, one language against the rest, gives the weights.
A batch is scored by matrix products: its sparse matrix of hashed n-grams' presence times the
landmarks' presence is the kernel, kernel times weights the decision values. Both products are
linear, so landmarks and weights are multiplied out once, in the fit, and a batch is one sparse
product for each n.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import of_texts, structs

LENGTHS = (1, 2, 3, 4)
BITS = 16
#: Labelled rows that the model is fitted on, for each language; chosen by a hash of their id, so the
#: same at any size of the table. Their texts are read whole.
SAMPLE = 500
#: Landmarks of each language.
LANDMARKS = 24
RIDGE = 1e-2
UNKNOWN = "und"
#: Languages are labels; their counts and shares are broadcast, so there must not be more.
MOST_LANGUAGES = 2000

#: A code point of category L, as in training.
_LETTER = regex.compile(r"\p{L}")
#: Numbers that a product of a batch holds at a time.
PRODUCT = 1 << 22


def grams(text: str) -> list[np.ndarray]:
    """Distinct n-grams of a text in lower case, white space as one space, for each n, hashed to BITS bits."""
    line = " " + " ".join(text.lower().split()) + " "
    codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32)
    out, h = [], np.zeros(len(codes), np.uint32)
    for n in LENGTHS:
        if len(codes) < n:
            out.append(np.zeros(0, np.int64))
            continue
        h = (h[: len(codes) - n + 1] + codes[n - 1 :]) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        found = np.zeros(1 << BITS, bool)
        found[(h * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS)] = True
        out.append(np.flatnonzero(found))
    return out


def sparse_product(rows: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
    """Rows of a 0/1 matrix, each as its columns that are 1 and scaled by the root of their number, times weights. No row is empty."""
    sizes = np.array([len(x) for x in rows])
    sums = np.add.reduceat(weights[np.concatenate(rows)], np.cumsum(sizes) - sizes, axis=0)
    return sums / np.sqrt(sizes)[:, None].astype(np.float32)


@dataclass
class Model:
    """languages in order, and the decision values' weights: n-gram length, hash, language."""

    languages: list[str]
    weights: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        """Decision values of a batch: a product of its sparse matrix of presence with the weights for each n."""
        out = np.zeros((len(texts), len(self.languages)), np.float32)
        found = [grams(x) for x in texts]
        for k in range(len(LENGTHS)):
            held, size = [], 0
            for i in range(len(found) + 1):
                n = len(found[i][k]) if i < len(found) else 0
                if held and (i == len(found) or (size + n) * len(self.languages) > PRODUCT):
                    out[held] += sparse_product([found[j][k] for j in held], self.weights[k])
                    held, size = [], 0
                if n:
                    held.append(i)
                    size += n
        return out

    def decisions(self, texts: list[str | None]) -> np.ndarray:
        """Largest decision value of each text: about 1 in a learned language, 0 or less in none; -inf where predict() says UNKNOWN.

        It doesn't shift with the number of languages, as a share among them does.
        """
        told = [i for i, x in enumerate(texts) if x is not None and self.languages and _LETTER.search(x)]
        out = np.full(len(texts), -np.inf)
        if told:
            out[told] = self.scores([texts[i] for i in told]).max(axis=1)
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and score (0 to 1) of each text; UNKNOWN and 0 for null, no letter or no language learned."""
        told = [i for i, x in enumerate(texts) if x is not None and self.languages and _LETTER.search(x)]
        out = [(UNKNOWN, 0.0)] * len(texts)
        if told:
            s = self.scores([texts[i] for i in told]).astype(float)
            best = s.argmax(axis=1)
            e = np.exp(4 * (s - s.max(axis=1, keepdims=True)))
            for i, b, p in zip(told, best.tolist(), (1 / e.sum(axis=1)).tolist(), strict=True):
                out[i] = (self.languages[b], float(p))
        return out


def fit(texts: list[str], languages: list[str]) -> Model:
    """Nyström features on LANDMARKS texts of each language, ridge regression of -1 and 1."""
    return fit_grams([grams(x) for x in texts], languages)


def fit_grams(found: list[list[np.ndarray]], languages: list[str]) -> Model:
    """fit() from the texts' grams()."""
    names = sorted(set(languages))
    if not names:
        return Model([], np.zeros((len(LENGTHS), 1 << BITS, 0), np.float32))
    by_language = [[i for i, y in enumerate(languages) if y == name] for name in names]
    rows = [i for g in by_language for i in g[:LANDMARKS]]
    presence = np.zeros((len(LENGTHS), 1 << BITS, len(rows)), np.float32)
    for j, i in enumerate(rows):
        for k, g in enumerate(found[i]):
            if len(g):
                presence[k, g, j] = 1 / (len(LENGTHS) * np.sqrt(len(g)))
    kernel = np.zeros((len(found), len(rows)))
    for i, gs in enumerate(found):
        for k, g in enumerate(gs):
            if len(g):
                kernel[i] += presence[k][g].sum(axis=0) / np.sqrt(len(g))
    values, vectors = np.linalg.eigh(kernel[rows])
    keep = values > 1e-6 * values[-1]
    root = vectors[:, keep] / np.sqrt(values[keep])
    features = kernel @ root
    target = np.where(np.array(languages)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    # Each language counts alike, however many rows it has.
    weight = np.array([1 / languages.count(y) for y in languages])[:, None]
    gram = features.T @ (weight * features) + RIDGE * np.eye(features.shape[1]) / len(found)
    ridge = np.linalg.solve(gram, features.T @ (weight * target))
    return Model(names, np.einsum("kdj,jc->kdc", presence, (root @ ridge).astype(np.float32)))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether crc32 of the id as text leaves no remainder; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Model:
    """Fits on at most ``sample`` rows a language of those that aren't held out and have a language and a text.

    The smallest hashes of the id are taken. Whole texts are read where they are; what comes to the
    driver is the numbers of their n-grams' hashes, so at most 2 bytes for each of 4 * 65,536 of
    ``sample`` rows a language, however long a text is.
    """
    from pyspark.sql import Window

    rows = docs.filter(F.col(lang_col).isNotNull() & ~held_out(F.col(id_col)))
    counts = {r["lang"]: r["n"] for r in rows.groupBy(F.col(lang_col).alias("lang")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError("too many languages")
    # A hash below this share is enough for the sample, with room to spare; then the exact cut.
    # An Arrow table, as a list's rows would go through Python workers of another daemon, which stay in the executors' memory.
    known = sorted(counts)
    shares = docs.sparkSession.createDataFrame(pa.table({"_lang": pa.array(known, pa.string()), "share": pa.array([min(1.0, 4.0 * sample / counts[k]) for k in known], pa.float64())}))
    near = rows.withColumn("_h", F.md5(F.col(id_col).cast("string"))).join(F.broadcast(shares), F.col(lang_col) == F.col("_lang"))
    near = near.filter(F.col(text_col).rlike("\\p{L}")).filter(F.conv(F.substring("_h", 1, 8), 16, 10).cast("double") / float(1 << 32) <= F.col("share"))
    ranked = near.selectExpr(f"`{lang_col}` as lang", f"`{text_col}` as text", "_h")
    top = ranked.withColumn("_n", F.row_number().over(Window.partitionBy("lang").orderBy("_h", "text"))).filter(F.col("_n") <= sample)
    taken = sorted(((r["lang"], r["_n"], r["grams"]) for r in top.select("lang", "_n", _packed(F.col("text")).alias("grams")).collect()), key=lambda r: r[:2])
    return fit_grams([[np.frombuffer(x, "<u2").astype(np.int64) for x in g] for _, _, g in taken], [lang for lang, _, _ in taken])


def _packed(text: Column) -> Column:
    """grams() of a text column, each as 2 bytes a hash."""

    def of(texts: list[str | None]) -> pa.Array:
        return pa.array([[g.astype("<u2").tobytes() for g in grams(x or "")] for x in texts], pa.list_(pa.binary()))

    return of_texts("array<binary>", of)(text)


def predicted(docs: DataFrame, model: Model, text: Column) -> Column:
    """struct(lang_pred, score) of a text column."""
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.weights.astype(np.float32)))

    def of(texts: list[str | None]) -> pa.Array:
        found = Model(*shared.value).predict(texts)
        return structs(lang_pred=pa.array([x for x, _ in found], pa.string()), score=pa.array([x for _, x in found], pa.float64()))

    return of_texts("lang_pred string, score double", of)(text)


def decided(docs: DataFrame, model: Model, text: Column) -> Column:
    """Model.decisions() of a text column."""
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.weights.astype(np.float32)))

    def of(texts: list[str | None]) -> pa.Array:
        return pa.array(Model(*shared.value).decisions(texts), pa.float64())

    return of_texts("double", of)(text)


def language_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """id, held_out, lang_pred and score of each row; predictions see the text alone.

    Null texts and those without a letter are UNKNOWN with score 0; so is every text when there is
    no labelled row. Repeated rows each get a row. Other columns aren't read.
    """
    model = train(docs, id_col, text_col, lang_col)
    out = docs.select(F.col(id_col).alias(id_col), held_out(F.col(id_col)).alias("held_out"), predicted(docs, model, F.col(text_col)).alias("p"))
    return out.select(id_col, "held_out", "p.lang_pred", "p.score")
