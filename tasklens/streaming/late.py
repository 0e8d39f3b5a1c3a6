"""Counts of a stream that lose no row: what comes too late for its window is a table of its own.

Spark's windowed aggregates drop a row whose window the watermark has passed and report how many. Here one query splits
every batch by its watermark: the newest event time of all batches before it, less the delay. Rows in time add to the counts of
their windows or sessions, late rows are stored as they are with the watermark that they missed. Counts are kept as partial
counts per batch, which add up in any order, so no state grows with the stream; what is still open when the stream is read is told
apart from what the watermark has closed. A batch that runs again replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tasklens.session import new_folder

_TIME = "event_ts"


@dataclass(frozen=True)
class Counted:
    """``counts`` with ``closed``, and the ``late`` rows with ``batch_id`` and the ``watermark`` that they missed."""

    counts: DataFrame
    late: DataFrame


def _mark(spark: SparkSession, folder: str, batch_id: int) -> int | None:
    """The newest event time, in microseconds, of all batches up to this one; None before the first."""
    if batch_id < 0:
        return None
    return spark.read.schema("high long").parquet(f"{folder}/marks/batch_id={batch_id}").first()["high"]


def _micros(spark: SparkSession, interval: str) -> int:
    return spark.range(1).select(F.expr(f"unix_micros(timestamp'1970-01-01 00:00:00 UTC' + interval {interval})")).first()[0]


def _split(events: DataFrame, purpose: str, end: Column, partial: Callable[[DataFrame], DataFrame], delay: str) -> tuple[str, int, int | None]:
    """Run ``events`` to the end of what is at hand: (folder, last batch, final watermark)."""
    spark = events.sparkSession
    folder = new_folder(spark, purpose)
    behind = _micros(spark, delay)
    last = -1

    def write(batch: DataFrame, batch_id: int) -> None:
        nonlocal last
        before = _mark(spark, folder, batch_id - 1)
        seen = Observation()
        newest = F.max(F.unix_micros(_TIME)).alias("high")
        held = batch.observe(seen, newest).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            watermark = F.lit(None if before is None else before - behind).cast("long")
            # A row without a time has no window to be late for, and none to be counted in.
            is_late = F.coalesce(F.unix_micros(end) <= watermark, F.col(_TIME).isNull())
            marked = held.withColumns({"_late": is_late, "watermark": F.timestamp_micros(watermark)})
            marked.filter("_late").drop("_late").write.mode("overwrite").parquet(f"{folder}/late/batch_id={batch_id}")
            in_time = marked.filter("not _late").drop("_late", "watermark")
            partial(in_time).write.mode("overwrite").parquet(f"{folder}/counts/batch_id={batch_id}")
        finally:
            held.unpersist()
        high = max((x for x in (before, seen.get["high"]) if x is not None), default=None)
        spark.createDataFrame([(high,)], "high long").write.mode("overwrite").parquet(f"{folder}/marks/batch_id={batch_id}")
        last = batch_id

    run = (
        events.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    final = _mark(spark, folder, last)
    return folder, last, None if final is None else final - behind


def _closed(end: Column, watermark: int | None) -> Column:
    return F.coalesce(F.unix_micros(end) <= F.lit(watermark).cast("long"), F.lit(False)).alias("closed")


def counted_windows(events: DataFrame, by: tuple[str, ...], size: str, delay: str = "1 hour") -> Counted:
    """Rows per tumbling window and ``by``: ``window_start, *by, n, closed``.

    A row is late once the watermark has reached its window's end. ``event_ts`` is an instant; a row without one is late.
    """
    spark = events.sparkSession
    width = _micros(spark, size)
    # Windows begin at whole multiples of their width, as those of F.window do.
    start = F.unix_micros(_TIME) - F.pmod(F.unix_micros(_TIME), F.lit(width))

    def partial(rows: DataFrame) -> DataFrame:
        window = (F.timestamp_micros(start).alias("start"), F.timestamp_micros(start + width).alias("end"))
        return rows.groupBy(*window, *by).agg(F.count("*").alias("n"))

    folder, _, watermark = _split(events, "windows", F.timestamp_micros(start + width), partial, delay)
    parts = spark.read.parquet(f"{folder}/counts").groupBy("start", "end", *by).agg(F.sum("n").alias("n"))
    counts = parts.select(F.col("start").alias("window_start"), *by, "n", _closed(F.col("end"), watermark))
    return Counted(counts, spark.read.parquet(f"{folder}/late"))


def counted_sessions(events: DataFrame, by: tuple[str, ...], gap: str, delay: str = "1 hour") -> Counted:
    """Rows per session, a run of rows of one ``by`` without a pause longer than ``gap``: ``session_start, session_end, *by, n, closed``.

    A row is late once the watermark has reached the end of a session that the row alone would be. Sessions of one batch are
    merged in it; sessions of several batches that overlap are one.
    """
    def partial(rows: DataFrame) -> DataFrame:
        session = F.session_window(_TIME, gap)
        return rows.groupBy(session.alias("w"), *by).agg(F.count("*").alias("n")).select("w.start", "w.end", *by, "n")

    end = F.col(_TIME) + F.expr(f"interval {gap}")
    folder, _, watermark = _split(events, "sessions", end, partial, delay)
    spark = events.sparkSession
    parts = spark.read.parquet(f"{folder}/counts").drop("batch_id")
    ordered = W.partitionBy(*by).orderBy("start", "end")
    reached = F.max("end").over(ordered.rowsBetween(W.unboundedPreceding, -1))
    begins = F.when(F.col("start") > reached, 1).otherwise(0)
    numbered = parts.withColumn("_begins", begins).withColumn("_session", F.sum("_begins").over(ordered.rowsBetween(W.unboundedPreceding, 0)))
    merged = numbered.groupBy(*by, "_session").agg(F.min("start").alias("session_start"), F.max("end").alias("session_end"), F.sum("n").alias("n"))
    counts = merged.select("session_start", "session_end", *by, "n", _closed(F.col("session_end"), watermark))
    return Counted(counts, spark.read.parquet(f"{folder}/late"))
