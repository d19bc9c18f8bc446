"""Quality rules: plain limits on words and repeats, then robust multivariate outliers.

For each language and source the minimum covariance determinant (MCD) of a vector of transformed
text statistics is estimated over all its documents, by deterministic starts: from coordinate-wise
medians and quartiles come three shapes (uncorrelated; the correlation of hyperbolic tangents; that
of spatial signs). Concentration steps take those SHARE of the rows that lie nearest, and set centre
and covariance anew from them. After two steps from each start the least determinant goes on, until
no step makes it smaller.

Estimates of a group, of its language and of all rows are blended: a group of n rows weighs
n / (n + OF_LANGUAGE) against its language, a language n / (n + OF_ALL) against all rows. So the
estimate changes smoothly with n, and no number of rows switches the method. Languages differ by
nature, so how far a language's centre is from the others' widens its covariance; a source's doesn't,
else a source of a few junk rows would pass for a kind of its own. A document is rejected if its squared Mahalanobis distance exceeds a quantile of the chi-squared
distribution.

Everything is counted over all rows by partial aggregates. Vectors are rounded to 1/SCALE and
distances ranked by fine steps of their logarithm, so that sums and ranks are whole numbers and do
not depend on the order of rows or tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.llm.common import of_texts, stored, structs, wrapped
from broadsheet.llm.textstats import text_stats

SCALE = 512
SHARE = 0.75
#: Rows that the estimate of a language counts for beside those of one of its sources, and that of
#: all rows beside a language's. The latter is below CUTOFF: so a language's own centre is always kept.
OF_LANGUAGE, OF_ALL = 100, 25
#: A step that lowers the logarithm of the determinant by less is none.
LEAST_FALL = 1e-9
#: Chi-squared, 6 degrees of freedom: the quantile that one in ten thousand exceeds, and those
#: that make the covariance of the nearest SHARE consistent: the SHARE quantile, and what share of
#: 8 degrees of freedom lies below it.
CUTOFF, INNER, INNER_SHARE = 27.86, 7.841, 0.5508
#: Standard deviation that each coordinate is taken to have at least; and the least eigenvalue in
#: these units, for groups of few rows.
FLOORS = (1.0, 0.08, 0.05, 0.05, 0.2, 0.2)
LEAST_EIGENVALUE = 0.05
#: Files of a table with a row for each group.
FILES = 4
#: Values of the starts' shapes are rounded to 1/SHAPE.
SHAPE = 4096
DIMS = len(FLOORS)
X = [f"x{i}" for i in range(DIMS)]
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct", "n_lines"]
FINE = 64  # steps of a distance's binary logarithm


def stats(text: Column, once: bool = False) -> Column:
    """struct of BASE, longs, of a whole text; null counts as empty. once: as in of_texts()."""

    def of(texts: list[str | None]) -> pa.Array:
        found = np.array([text_stats(x) for x in texts], np.int64).reshape(-1, len(BASE))
        return structs(**{c: pa.array(found[:, i]) for i, c in enumerate(BASE)})

    return of_texts(", ".join(f"{c} long" for c in BASE), of, once)(text)


def base_failed(s: str = "") -> Column:
    return F.expr(f"{s}n_words < 20 or 100 * {s}n_repeat_words > 30 * {s}n_words")


def vector(s: str = "") -> list[Column]:
    """Transformed statistics in 1/SCALE: length, word length, symbols, variety, repeated lines and passages."""
    words = f"greatest({s}n_words, 1)"
    exprs = [
        f"ln({words})",
        f"ln(greatest({s}word_chars, 1) / {words})",
        f"sqrt({s}n_symbols / greatest({s}word_chars, 1))",
        f"ln(greatest({s}n_distinct, 1)) / ln({words} + 1)",
        f"sqrt({s}n_dup_lines / greatest({s}n_lines, 1))",
        f"sqrt({s}n_repeat_words / {words})",
    ]
    return [F.expr(f"cast(round({SCALE} * ({e})) as long)").alias(x) for e, x in zip(exprs, X, strict=True)]


def covariance(cov: np.ndarray) -> np.ndarray:
    """A covariance with the floors: on the diagonal, and on eigenvalues in the floors' units."""
    floors = np.array(FLOORS)
    cov = cov + np.diag(np.maximum(0, floors**2 - np.diag(cov)))
    values, vectors = np.linalg.eigh(cov / np.outer(floors, floors))
    if values[0] >= LEAST_EIGENVALUE:
        return cov
    return (vectors * np.maximum(values, LEAST_EIGENVALUE)) @ vectors.T * np.outer(floors, floors)


def _solve(sums: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, params, logdet): centre and inverse covariance (row by row) of sums by group, and the logarithm of its determinant."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for row in f.to_dict("records"):
                n = row["n"]
                mean = np.array([float(row[f"s{i}"]) for i in range(DIMS)]) / n
                cov = np.array([[float(row[f"s{min(i, j)}_{max(i, j)}"]) for j in range(DIMS)] for i in range(DIMS)]) / n - np.outer(mean, mean)
                cov = covariance(cov / SCALE**2 * (SHARE / INNER_SHARE))
                out.append((*[row[k] for k in keys], [*(mean / SCALE), *np.linalg.inv(cov).ravel()], float(np.linalg.slogdet(cov)[1])))
            yield pd.DataFrame(out, columns=[*keys, "params", "logdet"])

    kinds = ", ".join(f"{k} {sums.schema[k].dataType.simpleString()}" for k in keys)
    return sums.mapInPandas(run, f"{kinds}, params array<double>, logdet double")


def _start(rows: DataFrame) -> DataFrame:
    """(g, params) from medians and quartiles, by exact histograms."""
    long = rows.select("g", F.explode(F.array(*[F.struct(F.lit(i).alias("d"), F.col(x).alias("v")) for i, x in enumerate(X)])).alias("c"))
    counts = long.groupBy("g", "c.d", "c.v").agg(F.count(F.lit(1)).alias("n"))
    of = Window.partitionBy("g", "d")
    up_to = counts.withColumn("upto", F.sum("n").over(of.orderBy("v"))).withColumn("all", F.sum("n").over(of))
    at = lambda q: F.min(F.when(F.col("upto") >= q * F.col("all"), F.col("v")))
    quartiles = up_to.groupBy("g", "d").agg(at(0.25).alias("a"), at(0.5).alias("b"), at(0.75).alias("c"))
    spread = F.greatest((F.col("c") - F.col("a")) / (1.349 * SCALE), F.element_at(F.array(*map(F.lit, FLOORS)), F.col("d") + 1))
    each = quartiles.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("d", (F.col("b") / SCALE).alias("m"), (1 / spread / spread).alias("w")))).alias("x"))
    inverse = F.flatten(F.transform("x", lambda r: F.transform("x", lambda c: F.when(r["d"] == c["d"], r["w"]).otherwise(0.0))))
    return each.select("g", F.concat(F.transform("x", lambda r: r["m"]), inverse).alias("params"))


def _shapes(rows: DataFrame, start: DataFrame) -> DataFrame:
    """(g, start, params) of three starts: that of start, uncorrelated, and two correlations with the same centre and scales.

    z is a row's distance from the median in robust deviations, coordinate by coordinate. tanh(z) bounds
    what one row can do to its correlation, z / |z| what it can do by being far.
    """
    z = rows.join(start, "g").select("g", *[F.expr(f"(x{i} / {float(SCALE)}D - params[{i}]) * sqrt(params[{DIMS + DIMS * i + i}])").alias(f"z{i}") for i in range(DIMS)])
    norm = "greatest(sqrt(" + " + ".join(f"z{i} * z{i}" for i in range(DIMS)) + "), 1e-9D)"
    whole = [F.expr(f"cast(round({SHAPE} * {e}) as long)").alias(f"{k}{i}") for i in range(DIMS) for k, e in (("t", f"tanh(z{i})"), ("u", f"z{i} / {norm}"))]
    sums = [F.sum(f"{k}{i}").alias(f"{k}s{i}") for k in "tu" for i in range(DIMS)]
    products = [F.sum(F.expr(f"{k}{i} * {k}{j}")).alias(f"{k}s{i}_{j}") for k in "tu" for i in range(DIMS) for j in range(i, DIMS)]
    shaped = z.select("g", *whole).groupBy("g").agg(F.count(F.lit(1)).alias("n"), *sums, *products).join(start, "g")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for row in f.to_dict("records"):
                params = np.array(row["params"])
                spread = 1 / np.sqrt(np.diag(params[DIMS:].reshape(DIMS, DIMS)))
                out.append((row["g"], 0, params.tolist()))
                for number, k in enumerate("tu", 1):
                    mean = np.array([float(row[f"{k}s{i}"]) for i in range(DIMS)]) / row["n"]
                    cov = np.array([[float(row[f"{k}s{min(i, j)}_{max(i, j)}"]) for j in range(DIMS)] for i in range(DIMS)]) / row["n"] - np.outer(mean, mean)
                    deviation = np.sqrt(np.maximum(np.diag(cov), 1.0))
                    shape = cov / np.outer(deviation, deviation)
                    np.fill_diagonal(shape, 1.0)
                    out.append((row["g"], number, [*params[:DIMS], *np.linalg.inv(covariance(shape * np.outer(spread, spread))).ravel()]))
            yield pd.DataFrame(out, columns=["g", "start", "params"])

    return shaped.mapInPandas(run, f"g {rows.schema['g'].dataType.simpleString()}, start int, params array<double>")


def with_distance(rows: DataFrame, name: str = "distance") -> DataFrame:
    """rows with the squared Mahalanobis distance of x0, x1, ... from params; null where params is.

    Offsets are columns of their own, so that each is worked out once and the code stays small enough
    to be compiled.
    """
    off = {f"_o{i}": F.col(x) * (1.0 / SCALE) - F.get("params", F.lit(i)) for i, x in enumerate(X)}
    terms = [F.expr(f"{1 if i == j else 2}D * _o{i} * _o{j}") * F.get("params", F.lit(DIMS + DIMS * i + j)) for i in range(DIMS) for j in range(i, DIMS)]
    return rows.withColumns(off).withColumn(name, sum(terms[1:], terms[0])).drop(*off)


def _step(rows: DataFrame, params: DataFrame) -> DataFrame:
    """One concentration step: (g, params, logdet) of the nearest SHARE of each group, for each row of params; a column start is kept."""
    keys = [k for k in ("g", "start") if k in params.columns]
    params = params.select(*keys, "params")

    def ranked(by: DataFrame) -> DataFrame:
        return with_distance(rows.join(by, "g"), "d").withColumn("bin", F.floor(FINE * F.log2(F.greatest("d", F.lit(1e-6)))))

    counts = ranked(params).groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"))
    of = Window.partitionBy(*keys)
    # As many rows as a distance has steps, whatever the table.
    upto = counts.withColumn("upto", F.sum("n").over(of.orderBy("bin"))).withColumn("all", F.sum("n").over(of))
    limits = upto.filter(F.col("upto") >= F.ceil(SHARE * F.col("all"))).groupBy(*keys).agg(F.min("bin").alias("limit"))
    limited = ranked(stored(params.join(limits, keys), "mcd-limits", files=FILES).select(*keys, "params", "limit"))
    return stored(_solve(_moments(limited.select(*keys, *X, "bin", "limit"), keys), keys), "mcd-params", files=FILES)


def _moments(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n, s0, s0_0, ...): number, sums and sums of products by group of rows whose bin is within their limit.

    Batches are cut and summed in Arrow first. In the JVM the filter would go into the join, and the
    distance with it, and with as many sums that is a method too long to be compiled.
    """
    names = ["n", *[f"s{i}" for i in range(DIMS)], *[f"s{i}_{j}" for i in range(DIMS) for j in range(i, DIMS)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.compute.less_equal(batch.column("bin"), batch.column("limit")))
            x = [batch.column(k) for k in X]
            columns = [pa.array(np.ones(batch.num_rows, np.int64)), *x, *[pa.compute.multiply(x[i], x[j]) for i in range(DIMS) for j in range(i, DIMS)]]
            table = pa.table([*[batch.column(k) for k in keys], *columns], names=[*keys, *names])
            found = table.group_by(keys).aggregate([(c, "sum") for c in names])
            yield from found.select([*keys, *[f"{c}_sum" for c in names]]).rename_columns([*keys, *names]).combine_chunks().to_batches()

    kinds = ", ".join([*[f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys], *[f"{c} long" for c in names]])
    return rows.mapInArrow(run, kinds).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in names])


def minimum_determinants(rows: DataFrame) -> DataFrame:
    """(g, params, logdet) of rows with g and x0, x1, ...: the least determinant found, and its centre and inverse covariance."""
    params = stored(_shapes(rows, stored(_start(rows), "mcd-params", files=FILES)), "mcd-params", files=FILES)
    for _ in range(2):
        params = _step(rows, params)
    best = params.groupBy("g").agg(F.min(F.struct(F.col("logdet"), F.col("start"), F.col("params"))).alias("b"))
    best = stored(best.select("g", "b.params", "b.logdet"), "mcd-params", files=FILES)
    ended, falling = [], best
    while not falling.isEmpty():
        after = _step(rows, falling).withColumnsRenamed({"params": "_params", "logdet": "_logdet"})
        both = stored(falling.join(after, "g").withColumn("falls", F.col("_logdet") < F.col("logdet") - LEAST_FALL), "mcd-params", files=FILES)
        ended.append(both.filter("not falls").select("g", "params", "logdet"))
        falling = both.filter("falls").select("g", F.col("_params").alias("params"), F.col("_logdet").alias("logdet"))
    out = ended[0] if ended else best
    for more in ended[1:]:
        out = out.unionByName(more)
    return out


def blend(n: float, centre: np.ndarray, cov: np.ndarray, outer: tuple[np.ndarray, np.ndarray], prior: float, apart: bool) -> tuple[np.ndarray, np.ndarray]:
    """Centre and covariance of n rows' estimate with that of prior rows outside; apart: with the covariance of the two centres, as a mixture has."""
    w, way = n / (n + prior), centre - outer[0]
    return w * centre + (1 - w) * outer[0], w * cov + (1 - w) * outer[1] + (w * (1 - w) * np.outer(way, way) if apart else 0)


def blended(parts: list[tuple[float, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Centre and covariance that a group is judged by, from (rows, centre, covariance) of all rows, its language and itself."""
    (n, centre, cov), language, own = parts
    return blend(*own, blend(*language, (centre, cov * (1 + OF_ALL / n)), OF_ALL, True), OF_LANGUAGE, False)


def estimates(rows: DataFrame) -> DataFrame:
    """(lang, source, params) of rows with lang, source and x0, x1, ...: a small table, a row for each pair of language and source."""
    hashed = lambda kind, *c: F.xxhash64(F.lit(kind), *[x for k in c for x in (F.col(k).isNull(), F.coalesce(k, F.lit("")))])
    named = rows.select("lang", "source", *X, F.array(hashed("all"), hashed("lang", "lang"), hashed("source", "lang", "source")).alias("gs"))
    own = stored(named.select(F.explode("gs").alias("g"), *X), "mcd-rows")
    pairs = stored(named.groupBy("lang", "source", "gs").agg(F.count(F.lit(1)).alias("n")), "mcd-groups", files=FILES)
    found = own.groupBy("g").agg(F.count(F.lit(1)).alias("n")).join(minimum_determinants(own), "g")
    found = stored(found.select("g", "n", "params"), "mcd-found", files=FILES)
    wide = pairs.select("lang", "source", "gs")
    for i in range(3):
        wide = wide.join(found.select(F.col("g").alias(f"g{i}"), F.col("n").alias(f"n{i}"), F.col("params").alias(f"p{i}")), F.col("gs")[i] == F.col(f"g{i}"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for row in f.to_dict("records"):
                params = [np.array(row[f"p{i}"]) for i in range(3)]
                centre, cov = blended([(row[f"n{i}"], p[:DIMS], np.linalg.inv(p[DIMS:].reshape(DIMS, DIMS))) for i, p in enumerate(params)])
                out.append((row["lang"], row["source"], [*centre, *np.linalg.inv(cov).ravel()]))
            yield pd.DataFrame(out, columns=["lang", "source", "params"])

    rows = wide.select("lang", "source", *[f"{c}{i}" for c in "np" for i in range(3)]).mapInPandas(run, "lang string, source string, params array<double>")
    return stored(rows, "mcd-estimates", files=FILES)


def _labelled(docs: DataFrame, lang_col: str, source_col: str, text_col: str, once: bool = False) -> tuple[Column, Column, Column]:
    return docs[lang_col].cast("string"), docs[source_col].cast("string"), stats(docs[text_col], once)


def _verdicts(rows: DataFrame, found: DataFrame) -> DataFrame:
    """rows with base_failed and kept."""
    named = found.withColumnsRenamed({"lang": "_l", "source": "_s"})
    joined = rows.join(named, rows["lang"].eqNullSafe(F.col("_l")) & rows["source"].eqNullSafe(F.col("_s")), "left")
    near = F.coalesce(F.col("distance") <= CUTOFF, F.lit(True))
    return with_distance(joined).withColumn("kept", ~F.col("base_failed") & near).withColumn("distance", F.round("distance", 4))


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """id, the base statistics, base_failed, kept and the squared distance (null without an estimate).

    Null texts are empty and fail; null languages and sources are groups like others. Estimates come
    from the rows that pass the base limits. Repeated rows each get a row and count as often.
    """
    lang, source, s = _labelled(docs, lang_col, source_col, text_col)
    light = docs.select(F.col(id_col).alias("id"), lang.alias("lang"), source.alias("source"), s.alias("s")).select("id", "lang", "source", "s.*")
    light = stored(light.select("*", base_failed().alias("base_failed"), *vector()), "quality-stats")
    found = estimates(light.filter(~F.col("base_failed")))
    return _verdicts(light, found).select(F.col("id").alias(id_col), *BASE[:5], "base_failed", "kept", "distance")


def quality_filter(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows of docs that quality_report keeps, with the columns of docs.

    Rows that pass the base limits are written with their statistics, so no text is read twice and
    none is moved; the verdicts need only a small table of estimates.
    """
    lang, source, s = _labelled(docs, lang_col, source_col, text_col, once=True)
    rows = wrapped(docs, lang=lang, source=source, s=s).filter(~base_failed("s."))
    rows = stored(rows.select("doc", "lang", "source", F.lit(False).alias("base_failed"), *vector("s.")), "quality-stats", "snappy")
    return _verdicts(rows, estimates(rows)).filter("kept").select("doc.*")
