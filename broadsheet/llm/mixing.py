"""Mixing sources to target weights by temperature, in DataFrame operations only.

Token shares are raised to an exponent between 0 (all sources alike) and 1 (as they are). Bisection
finds the largest exponent whose weights reach a target entropy, or the smallest that keeps every
source within a repetition limit. A source's documents then follow each other in a hashed order,
epoch after epoch, and blocks of a fixed budget take from each stream what its weight is worth.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.llm.common import cut, wrapped

STEPS = 50
#: Weights are whole millionths, so that all that follows is whole-number arithmetic.
PARTS = 1_000_000
#: Sources are labels, and their table is an array of one row; more than this is taken for an error.
MOST_SOURCES = 100_000


def source_weights(totals: DataFrame, target_entropy: float | None = None, repetition_limit: float | None = None) -> DataFrame:
    """(source, tokens, exponent, parts, budget, quota) of a table (source, tokens) with tokens > 0.

    target_entropy: as a share of ln(number of sources), from 0 to 1; the exponent is the largest in
    [0, 1] that reaches it. repetition_limit: the most that a source is repeated when the source
    with the least weight for its size is used once; the exponent is the smallest in [0, 1] that
    keeps to it. With both, the entropy gives way to the limit. parts: weight in millionths, rounded,
    at least 1. budget: the fewest tokens for which every source is used once or more; quota: the
    source's share of it. The sources are labels and make one row's array, see MOST_SOURCES.
    """
    if target_entropy is None and repetition_limit is None:
        raise ValueError("give a target entropy or a repetition limit")
    rows = totals.agg(F.array_sort(F.collect_list(F.struct(F.col("tokens").cast("double").alias("t"), F.col("tokens").alias("n"), F.col("source").alias("s")))).alias("rows"), F.count(F.lit(1)).alias("k"))
    rows = rows.filter(F.when(F.col("k") > MOST_SOURCES, F.raise_error(F.lit("too many sources"))).otherwise(F.col("k") > 0))
    logs = rows.select("rows", F.transform("rows", lambda x: F.log(x["t"])).alias("l"), F.array_max(F.transform("rows", lambda x: F.log(x["t"]))).alias("top"))

    def total(a: Column, of) -> Column:
        return F.aggregate("l", F.lit(0.0), lambda s, x: s + of(F.exp(a * (x - F.col("top"))), x))

    def entropy(a: Column) -> Column:
        z = total(a, lambda e, x: e)
        return F.log(z) - total(a, lambda e, x: e * a * (x - F.col("top"))) / z

    def repeats(a: Column) -> Column:
        # weight / tokens grows as tokens fall: the smallest source is repeated most
        return F.exp((F.lit(1.0) - a) * (F.col("top") - F.array_min("l")))

    def bisected(ok_at_low) -> Column:
        """The largest exponent found for which ok_at_low holds, given that it fails from some point on."""
        start = F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"))

        def step(s: Column, _: Column) -> Column:
            mid = (s["lo"] + s["hi"]) / 2
            return F.struct(F.when(ok_at_low(mid), mid).otherwise(s["lo"]).alias("lo"), F.when(ok_at_low(mid), s["hi"]).otherwise(mid).alias("hi"))

        return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step)

    exponent = F.lit(0.0)
    if target_entropy is not None:
        goal = F.lit(float(target_entropy)) * F.log(F.size("l").cast("double")) - 1e-12
        exponent = F.when(entropy(F.lit(1.0)) >= goal, F.lit(1.0)).otherwise(bisected(lambda a: entropy(a) >= goal)["lo"])
    if repetition_limit is not None:
        most = F.lit(float(repetition_limit)) * (1 + 1e-12)
        least = F.when(repeats(F.lit(0.0)) <= most, F.lit(0.0)).otherwise(bisected(lambda a: repeats(a) > most)["hi"])
        exponent = F.greatest(exponent, least)
    solved = logs.select("rows", "top", exponent.alias("exponent"))
    norm = F.aggregate("rows", F.lit(0.0), lambda s, x: s + F.exp(F.col("exponent") * (F.log(x["t"]) - F.col("top"))))
    weighed = solved.select("rows", "top", "exponent", norm.alias("norm"))
    parts = F.transform("rows", lambda x: F.greatest(F.lit(1), F.round(PARTS * F.exp(F.col("exponent") * (F.log(x["t"]) - F.col("top"))) / F.col("norm"))).cast("long"))
    parted = weighed.select("exponent", F.arrays_zip("rows", parts.alias("parts")).alias("all"))
    # The fewest tokens for which every source is used once or more.
    budget = F.array_max(F.transform("all", lambda x: F.ceil(x["rows"]["n"] * F.lit(PARTS) / x["parts"]).cast("long")))
    each = parted.select("exponent", budget.alias("budget"), F.explode("all").alias("x"))
    out = each.select(F.col("x.rows.s").alias("source"), F.col("x.rows.n").alias("tokens"), "exponent", F.col("x.parts").alias("parts"), "budget")
    return out.withColumn("quota", F.expr(f"greatest(tokens, budget * parts div {PARTS})"))


def keyed(docs: DataFrame, tokens: Column, id_col: str, source_col: str, seed: str) -> DataFrame:
    """(id, source, tokens, key): key is the place of a document in its source's permutation.

    Null ids and sources are values of their own. Every document has at least one token.
    """
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    return docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.greatest(tokens.cast("long"), F.lit(1)).cast("long").alias("tokens"), key.alias("key"))


def streams(rows: DataFrame, rows_per_run: int = 10_000) -> DataFrame:
    """rows of keyed() with before: tokens of its source that come earlier in the permutation.

    No task sees a whole source: rows are summed in runs of hashes (key prefixes), of about
    rows_per_run rows. Rows that are equal in every column take their places in either order.
    """
    n = rows.groupBy("source").count().agg(F.max("count")).first()[0] or 0
    digits = 0
    while n > rows_per_run * 16**digits:
        digits += 1
    runs = rows.withColumn("run", F.substring("key", 1, digits) if digits else F.lit(""))
    sizes = runs.groupBy("source", "run").agg(F.sum("tokens").alias("size"))
    earlier = Window.partitionBy("source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("source").alias("of"), F.col("run").alias("of_run"), F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("start"))
    within = Window.partitionBy("source", "run").orderBy("key", "id", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    inside = runs.withColumn("inside", F.coalesce(F.sum("tokens").over(within), F.lit(0)))
    joined = inside.join(starts, inside["source"].eqNullSafe(starts["of"]) & (inside["run"] == starts["of_run"]))
    return joined.select("id", inside["source"], "tokens", "key", (F.col("start") + F.col("inside")).alias("before"))


def mixture(docs: DataFrame, tokens: Column, block_tokens: int, id_col: str = "doc_id", source_col: str = "source", target_entropy: float | None = None, repetition_limit: float | None = None, seed: str = "mix:") -> DataFrame:
    """Every use of every document: id, source, tokens, epoch, block and slot in it.

    Source s has a quota of the (lossless) budget. Its documents in permuted order, repeated, form a
    stream; those that begin before the quota is used up are taken, so each document at least once.
    A block takes block_tokens * parts / PARTS tokens of each stream, by where a document begins.
    slot is the place in the block's permutation, from 0, by a hash: so the sources mix. A block is
    ranked by itself, and its budget bounds it. Empty tables give no rows.
    """
    rows = cut(keyed(docs, tokens, id_col, source_col, seed))
    weights = source_weights(rows.groupBy("source").agg(F.sum("tokens").alias("tokens")), target_entropy, repetition_limit)
    weights = cut(weights).select(F.col("source").alias("of"), F.col("tokens").alias("size"), "exponent", "parts", "budget", "quota")
    placed = streams(rows)
    placed = placed.join(weights, placed["source"].eqNullSafe(weights["of"]))
    uses = F.expr("(quota - before + size - 1) div size")
    taken = placed.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(uses, F.lit(1)) - 1)))
    at = F.col("before") + F.col("epoch") * F.col("size")
    share = F.greatest(F.lit(1), F.expr(f"{block_tokens} * parts div {PARTS}"))
    taken = taken.withColumn("at", at).withColumn("share", share)
    order = F.md5(F.concat("key", F.lit(":"), F.col("epoch").cast("string")))
    blocked = taken.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "tokens", "epoch", F.col("at").alias("stream_at"), F.expr("at div share").alias("block"), order.alias("order"), "parts", "budget", "quota")
    slot = F.row_number().over(Window.partitionBy("block").orderBy("order", "stream_at", source_col)) - 1
    return blocked.withColumn("slot", slot.cast("long")).drop("order")


def mix(docs: DataFrame, tokens: Column, id_col: str = "doc_id", source_col: str = "source", target_entropy: float | None = None, repetition_limit: float | None = None, seed: str = "mix:") -> DataFrame:
    """docs with each row as often as mixture() uses it, and no text moved.

    How often a row is used follows from its key and its source's cutoff: the last key of the epoch
    that the quota breaks off in. Rows of one id have one key, so all of them are used as often as
    the first. Columns are those of docs.
    """
    rows = cut(keyed(docs, tokens, id_col, source_col, seed))
    weights = source_weights(rows.groupBy("source").agg(F.sum("tokens").alias("tokens")), target_entropy, repetition_limit)
    weights = cut(weights).select(F.col("source").alias("_of"), F.expr("quota div tokens").alias("_whole"), F.expr("quota % tokens").alias("_rest"))
    placed = streams(rows)
    placed = placed.join(weights, placed["source"].eqNullSafe(weights["_of"])).filter(F.col("before") < F.col("_rest"))
    cutoffs = placed.groupBy(F.col("source").alias("_at")).agg(F.max("key").alias("_cutoff"))
    plan = cut(weights.join(cutoffs, weights["_of"].eqNullSafe(cutoffs["_at"]), "left").select("_of", "_whole", F.coalesce("_cutoff", F.lit("")).alias("_cutoff")))
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    joined = wrapped(docs, key=key, source=F.col(source_col)).join(plan, F.col("source").eqNullSafe(F.col("_of")))
    uses = F.col("_whole") + F.when(F.col("key") <= F.col("_cutoff"), 1).otherwise(0)
    return joined.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), uses))).select("doc.*")
