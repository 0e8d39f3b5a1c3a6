"""Questions about tasks, workers and queues, over canonical events."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tasklens import constants as K
from tasklens.functions.names import present
from tasklens.operators.ordered import Running, running
from tasklens.session import checkpointed, stored

_PLACE = ("event_ts", "event_id")


def task_latest_state(events: DataFrame) -> DataFrame:
    """Per task: the latest kind, first and last time, and the latest worker, queue and name known."""
    place = F.struct(*_PLACE)

    def latest(c: str) -> Column:
        return F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(c)

    return events.groupBy("task_id").agg(
        F.max_by("kind", place).alias("kind"),
        F.min("event_ts").alias("first_ts"),
        F.max("event_ts").alias("last_ts"),
        F.count("*").alias("n_events"),
        latest("worker"),
        latest("queue"),
        latest("task_name"),
    )


def task_runtime_stats(
    events: DataFrame, points: tuple[float, ...] = (0.5, 0.95), key_row_budget: int | None = None
) -> DataFrame:
    """Per task name: count, average, extremes and exact percentiles (interpolated) of ``runtime_ms``.

    Equal runtimes are counted together first, so neither a frequent task nor a frequent value weighs on one task.
    Running counts then give every value its rank among its task's, whose total is known from the same counts.
    """
    by_value = events.filter(F.col("runtime_ms").isNotNull()).groupBy("task_name", "runtime_ms").agg(F.count("*").alias("_n"))
    # Two passes over the counts, none over the events.
    by_value = stored(by_value, "runtimes")
    counts = running(by_value, ["task_name"], ("runtime_ms",), [[Running("_upto", F.col("_n"), "sum")]], key_row_budget)
    totals = by_value.groupBy(F.col("task_name").alias("_task")).agg(F.sum("_n").alias("_total"))
    counts = counts.join(totals, F.col("task_name").eqNullSafe(F.col("_task")))
    last = F.col("_total") - 1
    ends = []
    for i, p in enumerate(points):
        for side, rank in (("low", F.floor(last * F.lit(p))), ("high", F.ceil(last * F.lit(p)))):
            ends.append(F.min(F.when(F.col("_upto") > rank, F.col("runtime_ms"))).alias(f"_{side}{i}"))
    folded = counts.groupBy("task_name").agg(
        F.sum("_n").alias("n"),
        F.sum(F.col("_n") * F.col("runtime_ms")).alias("_sum"),
        F.min("runtime_ms").alias("min_ms"),
        F.max("runtime_ms").alias("max_ms"),
        *ends,
    )
    percentiles = []
    for i, p in enumerate(points):
        at = (F.col("n") - 1) * F.lit(p)
        low, high = F.col(f"_low{i}"), F.col(f"_high{i}")
        percentiles.append((low + (high - low) * (at - F.floor(at))).alias(f"p{round(p * 100)}_ms"))
    return folded.select(
        "task_name", "n", (F.col("_sum") / F.col("n")).alias("avg_ms"), "min_ms", "max_ms", *percentiles
    )


def task_runtime_sketch(events: DataFrame, points: tuple[float, ...] = (0.5, 0.95), accuracy: int = 10_000) -> DataFrame:
    """``task_runtime_stats`` with approximate percentiles, in one pass and one small shuffle."""
    return (
        events.filter(F.col("runtime_ms").isNotNull())
        .groupBy("task_name")
        .agg(
            F.count("*").alias("n"),
            F.avg("runtime_ms").alias("avg_ms"),
            F.min("runtime_ms").alias("min_ms"),
            F.max("runtime_ms").alias("max_ms"),
            *[F.percentile_approx("runtime_ms", p, accuracy).alias(f"p{round(p * 100)}_ms") for p in points],
        )
    )


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def task_phase_times(events: DataFrame) -> DataFrame:
    """Per task: waiting (received to started) and running (started to end) time in microseconds."""
    def first(*kinds: str) -> Column:
        return F.min(F.when(F.col("kind").isin(*kinds), F.col("event_ts")))

    phases = events.groupBy("task_id").agg(
        first("received").alias("received_ts"),
        first("started").alias("started_ts"),
        first(*K.TERMINAL_KINDS).alias("ended_ts"),
    )
    return phases.withColumns(
        {
            "wait_us": _micros(F.col("started_ts")) - _micros(F.col("received_ts")),
            "run_us": _micros(F.col("ended_ts")) - _micros(F.col("started_ts")),
        }
    )


def deadline_breaches(events: DataFrame) -> DataFrame:
    """Runs that took longer than their task's expected duration or deadline; needs the metadata columns."""
    over = [
        (F.col("runtime_ms") > F.col(limit)).alias(name)
        for name, limit in (("over_expected", "expected_duration_ms"), ("over_deadline", "deadline_ms"))
    ]
    return (
        events.filter(F.col("runtime_ms").isNotNull())
        .filter((F.col("runtime_ms") > F.col("expected_duration_ms")) | (F.col("runtime_ms") > F.col("deadline_ms")))
        .select("event_id", "task_id", "task_name", "runtime_ms", "expected_duration_ms", "deadline_ms", *over)
    )


def failure_breakdown(events: DataFrame) -> DataFrame:
    """Failures by exception, task and worker with subtotals; ``level`` tells total rows from NULL values."""
    return (
        events.filter(F.col("kind") == "failed")
        .rollup("exception", "task_name", "worker")
        .agg(F.count("*").alias("n"), F.grouping_id().alias("level"))
    )


def failure_cube(events: DataFrame) -> DataFrame:
    """Failures by every combination of exception and worker."""
    return (
        events.filter(F.col("kind") == "failed")
        .cube("exception", "worker")
        .agg(F.count("*").alias("n"), F.grouping_id().alias("level"))
    )


def tag_counts(events: DataFrame) -> DataFrame:
    """Events per tag; counted per tag list before the lists are opened."""
    lists = events.filter(F.size("tags") > 0).groupBy("tags").agg(F.count("*").alias("_n"))
    return lists.select(F.explode("tags").alias("tag"), "_n").groupBy("tag").agg(F.sum("_n").alias("n"))


def task_depths(lineage: DataFrame) -> DataFrame:
    """Add ``depth``, a task's distance from the top of its tree; NULL for tasks that lead into a cycle.

    ``lineage(task_id, parent_task_id, root_task_id)`` holds one row per task. Each round replaces every open
    task's pointer by its ancestor's pointer, so pointers double their reach and a tree of depth d takes log2(d)
    rounds. Tasks that have reached the top leave the rounds, so tops never become a hot key.
    """
    known = lineage.select(F.col("task_id").alias("_known"))
    has_parent = present(F.col("parent_task_id")).isNotNull()
    children = lineage.filter(has_parent).join(known, F.col("parent_task_id") == F.col("_known"), "left")
    tops = lineage.filter(~has_parent).withColumn("_known", F.lit(None).cast("string"))
    nodes = checkpointed(
        children.unionByName(tops).select(
            "task_id",
            "root_task_id",
            F.col("_known").alias("above"),
            F.when(F.col("_known").isNull(), 0).otherwise(1).cast("long").alias("depth"),
        )
    )
    total = nodes.count()
    for _ in range(math.ceil(math.log2(max(total, 1))) + 1):
        still_open = nodes.filter("above is not null")
        if still_open.isEmpty():
            break
        done = nodes.filter("above is null")
        jumps = nodes.select(
            F.col("task_id").alias("_at"), F.col("above").alias("_above"), F.col("depth").alias("_depth")
        )
        moved = still_open.join(jumps, F.col("above") == F.col("_at")).select(
            "task_id",
            "root_task_id",
            F.col("_above").alias("above"),
            (F.col("depth") + F.col("_depth")).alias("depth"),
        )
        nodes = checkpointed(done.unionByName(moved))
    return nodes.select("task_id", "root_task_id", F.when(F.col("above").isNull(), F.col("depth")).alias("depth"))


def task_tree(lineage: DataFrame) -> DataFrame:
    """Size and depth of every task tree."""
    return (
        task_depths(lineage)
        .groupBy("root_task_id")
        .agg(F.count("*").alias("size"), F.max("depth").alias("depth"))
    )


def priority_mix(tasks: DataFrame) -> DataFrame:
    """Tasks per queue, one column per priority; the columns are fixed, so the values are not scanned for."""
    return (
        tasks.groupBy("queue")
        .pivot("priority", list(K.PRIORITIES))
        .agg(F.count(F.lit(1)))
        .na.fill(0, list(K.PRIORITIES))
    )


def retry_chains(events: DataFrame, key_row_budget: int | None = None) -> DataFrame:
    """Each retry with its attempt number and the microseconds since its task's previous retry."""
    retries = events.filter(F.col("kind") == "retried").select("event_id", "task_id", "event_ts")
    levels = [
        [
            Running("attempt", F.lit(1), "sum"),
            Running("previous_ts", F.col("event_ts"), "last", inclusive=False),
        ]
    ]
    chained = running(retries, ["task_id"], _PLACE, levels, key_row_budget)
    gap = _micros(F.col("event_ts")) - _micros(F.col("previous_ts"))
    return chained.withColumn("gap_us", gap).drop("previous_ts")


def worker_load(events: DataFrame, approximate: bool = False) -> DataFrame:
    """Per worker: events, distinct tasks, and the dense rank by events.

    Ranked are the distinct numbers of events, not the workers: so many different numbers add up to no more events than
    there are, so their list stays short (some millions for ten trillion events) however many workers share one.
    """
    known = events.filter(F.col("worker").isNotNull())
    if approximate:
        load = known.groupBy("worker").agg(
            F.count("*").alias("n_events"), F.approx_count_distinct("task_id").alias("n_tasks")
        )
    else:
        per_task = known.groupBy("worker", "task_id").agg(F.count("*").alias("_n"))
        load = per_task.groupBy("worker").agg(
            F.sum("_n").alias("n_events"), F.count("task_id").alias("n_tasks")
        )
    load = stored(load, "loads")
    values = load.select(F.col("n_events").alias("_value")).distinct()
    ranks = values.withColumn("load_rank", F.dense_rank().over(W.orderBy(F.desc("_value"))).cast("long"))
    return load.join(ranks, F.col("n_events") == F.col("_value")).select("worker", "n_events", "n_tasks", "load_rank")
