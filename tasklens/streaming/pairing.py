"""Both capture paths of one stream: which broker event and which signal tell of the same transition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasklens.functions.names import present
from tasklens.operators.canonical import owns

_SIDES = ("broker", "signal")


def pair_captures(broker: DataFrame, signals: DataFrame, tolerance: str = "5 seconds", delay: str = "1 hour") -> DataFrame:
    """One row per transition of two streams of canonical events, as soon as no partner can come any more.

    A broker event and a signal of one task and kind pair up if their times are at most ``tolerance`` apart. A row has the event of
    the path that owns its kind where there is one, else the other's, and the ids of both; events of either path without a
    partner stay as they are. Both streams have a watermark ``delay`` behind their newest event, so the join keeps no more
    than that much of each; events that come later are left out by Spark. Events without a task id pair with none.
    """
    sides = {}
    for name, events in zip(_SIDES, (broker, signals), strict=True):
        timed = events.withWatermark("event_ts", delay)
        # An event without a task is a task of its own.
        task = F.coalesce(present(F.col("task_id")), F.concat(F.lit("\x00"), "event_id"))
        sides[name] = timed.select(task.alias(f"{name}_task"), *[F.col(c).alias(f"{name}_{c}") for c in events.columns])
    near = F.expr(
        f"signal_event_ts >= broker_event_ts - interval {tolerance} AND signal_event_ts <= broker_event_ts + interval {tolerance}"
    )
    same = (F.col("broker_task") == F.col("signal_task")) & (F.col("broker_kind") == F.col("signal_kind")) & near
    joined = sides["broker"].join(sides["signal"], same, "full_outer")
    # The owner's event where both are there.
    kind = F.coalesce("broker_kind", "signal_kind")
    signal_first = F.col("signal_event_id").isNotNull() & (owns(F.lit("signal"), kind) | F.col("broker_event_id").isNull())
    columns = [c for c in broker.columns if c in signals.columns]
    chosen = [F.when(signal_first, F.col(f"signal_{c}")).otherwise(F.col(f"broker_{c}")).alias(c) for c in columns]
    return joined.select(*chosen, F.col("broker_event_id").alias("broker_id"), F.col("signal_event_id").alias("signal_id"))
