"""Incremental ingestion with Structured Streaming."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from broadsheet.sources.files import WatchConfig, list_files, name_selector, ready, shared_folder


def timed(rows: DataFrame, column: str = "ts") -> DataFrame:
    """Event time as an instant: a watermark rejects local timestamps."""
    return rows.withColumn(column, F.col(column).cast("timestamp"))


def discover(spark: SparkSession, config: WatchConfig, ledger: DataFrame, selectors: tuple[str, ...] = ()) -> DataFrame:
    """Files of a round: selected, ready, not processed, newest first; only the newest in latest mode.

    A listing, not a file stream: a stream marks a file as seen before it has settled, while here
    what isn't ready yet is looked at again in the next round.
    """
    files = list_files(spark, config.input_dir, config.pattern, content=True)
    files = files.filter(name_selector(F.col("name"), F.col("stem"), selectors))
    age = F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("mtime")
    files = files.filter(ready(F.col("size"), age, F.col("has_eof"), config.min_bytes, config.settle_seconds))
    new = files.join(ledger.select("sha256"), "sha256", "left_anti").orderBy(F.col("mtime").desc(), F.col("name").desc())
    return new.limit(1) if config.selection_mode == "latest" else new


def dedupe_stream(stream: DataFrame, keys: list[str], time: str, lateness: str) -> DataFrame:
    """First row of each key within the lateness; state is dropped behind the watermark."""
    return stream.withWatermark(time, lateness).dropDuplicatesWithinWatermark(keys)


def window_counts(stream: DataFrame, time: str, width: str, lateness: str, *keys: str) -> DataFrame:
    return stream.withWatermark(time, lateness).groupBy(F.window(time, width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), *keys, "n")


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Handles all that is there, batch by batch, then stops."""
    stream.writeStream.foreachBatch(each).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def available_table(stream: DataFrame, root: str, mode: str = "append") -> DataFrame:
    """What a stream has given once all that is there was handled, from a table below root.

    In complete mode the last batch is the table; in append mode the batches make it together, each
    written to its own folder so that a repeated batch replaces itself.
    """
    name = f"{root}/stream-{uuid.uuid4().hex}"

    def each(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{name}/out/part={number if mode == 'append' else 0}")

    run_available(stream, f"{name}/log", each, mode)
    return stream.sparkSession.read.parquet(f"{name}/out").drop("part")


def commit_complete(batch: DataFrame, ledger_rows: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Ledger rows of those issues of a batch that are complete: no failed page, an article, all pages there."""
    done = batch.filter((F.size("failed_pages") == 0) & (F.col("article_count") > 0) & (F.col("pages_done") == F.col("page_count")))
    return ledger_rows(done)


def retry_schedule(failures: DataFrame, cooldown: int = 30, rounds: int = 3) -> DataFrame:
    """(key, round, due) of each failure (key, failed_at): cooldowns of 1, 3, 6, 12, ... times the first, added up.

    The queue of deferred work as rows; what is due is a filter on time.
    """
    factor = F.when(F.col("round") == 1, 1).otherwise(F.expr("3 * shiftleft(1, round - 2)"))
    rows = failures.withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(rounds))))
    due = F.sum(factor * cooldown).over(Window.partitionBy("key").orderBy("round"))
    return rows.select("key", F.col("round").cast("long").alias("round"), F.timestamp_add("SECOND", due, "failed_at").alias("due"))


def stale(rows: DataFrame, versions: dict[str, int]) -> DataFrame:
    """Rows whose stored version of anything is missing or older than it is now."""
    out = F.lit(False)
    for column, now in versions.items():
        out = out | F.coalesce(F.col(column) < now, F.lit(True))
    return rows.filter(out)


def poll(once: Callable[[dict], None], read_config: Callable[[], dict], rounds: int | None = None, interval: float | None = None, wait: Callable[[float], None] = time.sleep) -> int:
    """Rounds of ingestion: the configuration is read anew for each, the wait between is its poll_interval_seconds, 5 at least.

    A round is a batch of its own, so whatever settles late is met by a later one. rounds: how many, else
    until interrupted. Returns how many there were.
    """
    done = 0
    try:
        while rounds is None or done < rounds:
            config = read_config()
            once(config)
            done += 1
            if rounds is None or done < rounds:
                wait(max(5.0, float(interval or config.get("poll_interval_seconds", 10800))))
    except KeyboardInterrupt:
        pass
    return done


def retry_rounds(pending: DataFrame, attempt: Callable[[DataFrame], DataFrame], done: Callable[[DataFrame, int], None], cooldown: float = 30, rounds: int = 3, wait: Callable[[float], None] = time.sleep) -> DataFrame:
    """Deferred work: each round tries what is left after a growing wait, and hands on what came through.

    attempt gives its rows with a column ok, and is written once a round (to the shared folder), so that
    a row is tried once and done and the next round see the same. Returns what is left.
    """
    spark = pending.sparkSession
    root = f"{shared_folder(spark)}/retries-{uuid.uuid4().hex}"
    for n in range(rounds):
        if pending.isEmpty():
            break
        wait(cooldown * (1 if n == 0 else 3 * 2 ** (n - 1)))
        attempt(pending).write.parquet(f"{root}/{n}")
        tried = spark.read.parquet(f"{root}/{n}")
        done(tried.filter("ok").drop("ok"), n + 1)
        pending = tried.filter("not ok").drop("ok")
    return pending
