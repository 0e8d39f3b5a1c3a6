"""Task names, per-task metadata, lineage and sibling look-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasklens import constants as K
from tasklens.functions.names import placeholder_name, present
from tasklens.operators.ordered import Running, running

ARRIVAL = ("event_ts", "event_id")


def carry_task_name(df: DataFrame, key_row_budget: int | None = None) -> DataFrame:
    """Add ``carried_name``: the event's own name, else the one remembered for its task.

    A named start remembers, an end forgets once it has been named itself. Both are writes to the same cell, so the
    remembered name is the last write before the row: one window, one shuffle by task.
    """
    named_start = (F.col("kind") == "started") & present(F.col("name")).isNotNull()
    write = F.when(named_start, F.struct(F.col("name").alias("value"))).when(
        F.col("kind").isin(*K.TERMINAL_KINDS), F.struct(F.lit(None).cast("string").alias("value"))
    )
    # Events without a task id neither write nor read, so each is a key by itself rather than one of a hot one.
    apart = F.when(present(F.col("uuid")).isNull(), F.xxhash64("event_id"))
    keyed = df.withColumn("_apart", apart)
    memory = Running("_memory", F.when(F.col("_apart").isNull(), write), "last", inclusive=False)
    out = running(keyed, ["uuid", "_apart"], ARRIVAL, [[memory]], key_row_budget)
    return out.withColumn(
        "carried_name", F.coalesce(present(F.col("name")), F.col("_memory.value"))
    ).drop("_memory", "_apart")


def with_task_name(df: DataFrame) -> DataFrame:
    """Add ``task_name``: the carried name, else a placeholder."""
    queue = F.col("queue") if "queue" in df.columns else None
    return df.withColumn("task_name", placeholder_name(F.col("carried_name"), F.col("uuid"), queue))


def join_task_meta(df: DataFrame, meta: DataFrame, apply: bool = True) -> DataFrame:
    """Add the metadata of each event's task; ``meta`` holds one row per ``task_name``.

    ``apply=False`` adds the columns empty, for the capture path that has no metadata at hand. No broadcast is
    forced: Spark broadcasts ``meta`` if it measures small, and splits hot task names otherwise.
    """
    columns = [c for c in meta.columns if c != "task_name"]
    if not apply:
        types = {f.name: f.dataType for f in meta.schema}
        return df.withColumns({c: F.lit(None).cast(types[c]) for c in columns})
    return df.join(meta, "task_name", "left")


def has_tags(tags: Column) -> Column:
    """Tags, or NULL where there are none."""
    return F.when(F.size(tags) > 0, tags)


def sampled(task_id: Column, rate: Column, skip: Column) -> Column:
    """True for the runs to report. The share is a property of the task id, so a run is kept whole or not at all."""
    share = F.conv(F.substring(F.md5(task_id), 1, 8), 16, 10).cast("double") / float(2**32)
    return (share < F.coalesce(rate, F.lit(1.0))) & ~F.coalesce(skip, F.lit(False))


def sample_events(df: DataFrame, task_id: str = "uuid") -> DataFrame:
    """The events whose task's ``sample_rate`` and ``skip`` let them be reported."""
    return df.filter(sampled(F.col(task_id), F.col("sample_rate"), F.col("skip")))


def validate_meta(meta: DataFrame) -> DataFrame:
    """Add ``problem``: why a metadata row is not allowed, NULL if it is."""
    rate = F.col("sample_rate")
    bad_rate = rate.isNotNull() & ~(rate.between(0.0, 1.0) & ~F.isnan(rate))
    bad_priority = F.col("priority").isNotNull() & ~F.col("priority").isin(*K.PRIORITIES)
    return meta.withColumn(
        "problem", F.when(bad_rate, "sample_rate").when(bad_priority, "priority")
    )


def link_lineage(df: DataFrame) -> DataFrame:
    """Empty parent and root ids are no ids."""
    return df.withColumns(
        {c: present(F.col(c)) for c in ("parent_task_id", "root_task_id")}
    )


def with_parent(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Add ``parent_<column>`` from each task's parent row; ``df`` holds one row per task."""
    parents = df.select(
        F.col("task_id").alias("_parent"), *[F.col(c).alias(f"parent_{c}") for c in columns]
    )
    # Roots have no parent to look up; keeping them out of the join keeps NULL from being its hot key.
    has_parent = F.col("parent_task_id").isNotNull()
    linked = df.filter(has_parent).join(parents, F.col("parent_task_id") == F.col("_parent"), "left")
    roots = df.filter(~has_parent)
    return linked.drop("_parent").unionByName(roots, allowMissingColumns=True)


def route_submission(submissions: DataFrame, registry: DataFrame) -> DataFrame:
    """Add ``route``: ``registered`` where the local registry knows the name, else ``by name``."""
    known = registry.select(F.col("name").alias("_known")).distinct()
    return (
        submissions.join(known, F.col("name") == F.col("_known"), "left")
        .withColumn("route", F.when(F.col("_known").isNotNull(), "registered").otherwise("by name"))
        .drop("_known")
    )


def enrich_dims(df: DataFrame, columns: tuple[str, ...] = ("worker", "queue")) -> DataFrame:
    """Fill each event's missing columns with the first value any event of its task carries."""
    place = F.struct(*ARRIVAL)
    firsts = df.filter(present(F.col("task_id")).isNotNull()).groupBy(F.col("task_id").alias("_task")).agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), place)).alias(f"_{c}") for c in columns]
    )
    return (
        df.join(firsts, F.col("task_id") == F.col("_task"), "left")
        .withColumns({c: F.coalesce(c, f"_{c}") for c in columns})
        .drop("_task", *[f"_{c}" for c in columns])
    )
