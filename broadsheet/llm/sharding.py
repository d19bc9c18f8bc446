"""Rendezvous hashing of stable record keys over weighted shards (free of any table of ranges).

Each key scores every shard; the best score wins. A new shard can only win rows for itself, and a
shard that goes loses only its own rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.llm.common import wrapped

#: Code of one branch a shard up to here; beyond it the shards are scored by an array function.
UNROLLED = 64


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """Shard (0-based int) of a key.

    A shard's score is -ln(u) / weight with u in (0, 1) hashed from key and shard number; the
    smallest score wins, the smaller number on a tie. Shards of weight 0 get no rows. A null key
    counts as one more value of its own, apart from the empty string.
    """
    if not any(w > 0 for w in weights) or any(w < 0 for w in weights):
        raise ValueError("weights must not be negative, and one must be positive")
    text = F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit(""))

    def score(shard: Column, weight: Column) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(text, shard), 11).cast("double") + 0.5) / float(1 << 53)
        return -F.log(u) / weight

    open_ = [(i, float(w)) for i, w in enumerate(weights) if w > 0]
    if len(open_) <= UNROLLED:
        found = [F.struct(score(F.lit(i), F.lit(w)).alias("s"), F.lit(i).alias("n")) for i, w in open_]
        return (F.least(*found) if len(found) > 1 else found[0])["n"]
    table = F.array(*[F.struct(F.lit(i).alias("n"), F.lit(w).alias("w")) for i, w in open_])
    return F.array_min(F.transform(table, lambda x: F.struct(score(x["n"], x["w"]).alias("s"), x["n"].alias("n"))))["n"]


def rendezvous_shards(df: DataFrame, key: str, weights: Sequence[float], shard: str = "shard", grown: str | None = None, grown_weight: float = 1.0) -> DataFrame:
    """df with the shard of each row's key, and with grown its shard once one more shard exists.

    Rows with equal keys, null ones included, share a shard. An empty table stays empty. No shuffle.
    A column of df with a new column's name is replaced.
    """
    out = df.withColumn(shard, shard_of(df[key], weights))
    return out.withColumn(grown, shard_of(df[key], [*weights, grown_weight])) if grown else out


def shard_slots(df: DataFrame, shard: str, order: Sequence[str], slot: str = "slot", rows_per_run: int = 50_000) -> DataFrame:
    """df with each row's place in its shard: gapless from 0, in the order of a hash of ``order``, unsigned.

    No task sees a whole shard: its rows are ranked in runs of about ``rows_per_run``, and a run
    begins where the runs before it end. Rows that equal each other in every column of ``order``
    take neighbouring places in either order. The counts read only the columns of ``order``.
    """
    keys = {f"o{i}": F.col(f"`{c}`") for i, c in enumerate(order)}
    n = df.groupBy(F.col(shard).alias("s")).count().agg(F.max("count")).first()[0] or 0
    bits = max(0, (n // rows_per_run).bit_length())
    rows = wrapped(df, s=F.col(shard), h=F.xxhash64(*keys.values()), **keys).withColumn("run", F.shiftrightunsigned("h", 64 - bits) if bits else F.lit(0).cast("long"))
    sizes = rows.groupBy("s", "run").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("s").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("s").alias("of"), F.col("run").alias("of_run"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    # Runs are prefixes of the unsigned hash, so that is the order within one too, however many there are.
    within = Window.partitionBy("s", "run").orderBy(F.col("h").bitwiseXOR(F.lit(-(1 << 63)).cast("long")), *keys)
    ranked = rows.withColumn("place", F.row_number().over(within) - 1)
    joined = ranked.join(starts, (ranked["s"] == starts["of"]) & (ranked["run"] == starts["of_run"]))
    kept = [F.col("doc").getField(c).alias(c) for c in df.columns if c != slot]
    return joined.select(*kept, (F.col("start") + F.col("place")).alias(slot))
