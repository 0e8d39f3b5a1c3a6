"""Stored task states, and what the workers say of themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasklens import constants as K
from tasklens.functions.control import canonical_state, lookup
from tasklens.functions.names import present
from tasklens.functions.text import tail

# The state a task is in after an event of each kind.
_STATE_AFTER = {
    "received": "PENDING",
    "started": "STARTED",
    "succeeded": "SUCCESS",
    "failed": "FAILURE",
    "retried": "RETRY",
    "revoked": "REVOKED",
}
SECTIONS = ("stats", "active", "active_queues", "registered", "conf")


def reconcile_record(backend: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """Stored results as ``task_id, engine_state, finished_at, exception`` and the columns ``also``."""
    state = canonical_state(F.col("state"))
    return backend.select(
        "task_id",
        state.alias("engine_state"),
        F.when(state.isin("success", "failure"), F.col("date_done")).alias("finished_at"),
        F.when(
            state == "failure", tail(present(F.col("traceback")), K.RECONCILE_TRACEBACK_CHARS)
        ).alias("exception"),
        *also,
    )


def state_drift(latest: DataFrame, backend: DataFrame) -> DataFrame:
    """Per task, the state its events imply against the stored one. Both inputs hold one row per ``task_id``."""
    seen = latest.select(
        "task_id", canonical_state(lookup(F.col("kind"), _STATE_AFTER)).alias("event_state")
    )
    stored = backend.select(
        F.col("task_id").alias("_stored"), canonical_state(F.col("state")).alias("stored_state")
    )
    verdict = (
        F.when(F.col("_stored").isNull(), "events only")
        .when(F.col("task_id").isNull(), "stored only")
        .when(F.col("event_state") == F.col("stored_state"), "match")
        .otherwise("drift")
    )
    return seen.join(stored, F.col("task_id") == F.col("_stored"), "full_outer").select(
        F.coalesce("task_id", "_stored").alias("task_id"), "event_state", "stored_state", verdict.alias("verdict")
    )


def known_queues(conf: DataFrame) -> DataFrame:
    """The queues each app consumes: the configured ones, else its default queue, else the product's default.

    ``conf(app, task_queues array<string>, task_default_queue string)``.
    """
    fallback = F.array(F.coalesce("task_default_queue", F.lit(K.DEFAULT_QUEUE)))
    configured = F.when(F.size("task_queues") > 0, F.col("task_queues"))
    return conf.select("app", F.explode(F.coalesce(configured, fallback)).alias("queue"))


def queue_depths(pending: DataFrame, known: DataFrame) -> DataFrame:
    """Messages per known queue, 0 where it is empty; queues that are not known are not reported."""
    depths = pending.groupBy(F.col("queue").alias("_queue")).agg(F.count("*").alias("_depth"))
    return (
        known.select("queue")
        .distinct()
        .join(depths, F.col("queue") == F.col("_queue"), "left")
        .select("queue", F.coalesce("_depth", F.lit(0)).alias("depth"))
    )


def worker_conf(conf: DataFrame) -> DataFrame:
    """The settings that may leave a worker, from ``conf(hostname, conf_key, conf_value)``; values are not looked at."""
    return conf.filter(F.col("conf_key").isin(*K.WORKER_CONF_KEYS))


def worker_conf_map(conf: DataFrame) -> DataFrame:
    """``worker_conf`` for workers that carry their settings as one map; no map counts as an empty one."""
    kept = F.map_filter("conf", lambda k, _v: k.isin(*K.WORKER_CONF_KEYS))
    return conf.withColumn("conf", F.coalesce(kept, F.create_map().cast("map<string,string>")))


def worker_details(replies: dict[str, DataFrame], hostname: str | None = None) -> DataFrame:
    """One row per worker that answered any of the inspections, with each reply where there is one.

    ``replies`` maps a section to ``(hostname, reply)`` tables; a reply may be of any type, another one in each section.
    They are stacked, a column per section, and folded in one aggregate, so there is one shuffle rather than one per
    section. Of several replies to one section any one is kept. A section without a table is an empty text column.
    """
    stacked = None
    for section, reply in replies.items():
        tagged = reply.select("hostname", F.col("reply").alias(section))
        stacked = tagged if stacked is None else stacked.unionByName(tagged, allowMissingColumns=True)
    if hostname is not None:
        stacked = stacked.filter(F.col("hostname") == hostname)
    return stacked.groupBy("hostname").agg(
        *[F.any_value(s, ignoreNulls=True).alias(s) if s in replies else F.lit(None).cast("string").alias(s) for s in SECTIONS]
    )


def recycle_limits(workers: DataFrame) -> DataFrame:
    """The child-recycling limits of forking pools, one row per limit that is set.

    ``workers(hostname, has_controller, pool, max_tasks_per_child, max_memory_per_child, worker_max_tasks_per_child,
    worker_max_memory_per_child)``: a controller's own value wins over the configured one.
    """
    forking = workers.filter(F.col("has_controller") & F.col("pool").contains(K.DEFAULT_POOL))
    effective = [
        F.coalesce(name.removeprefix("worker_"), name).cast("bigint").alias(name) for name in K.RECYCLE_LIMITS
    ]
    return (
        forking.select("hostname", *effective)
        .unpivot("hostname", list(K.RECYCLE_LIMITS), "setting", "value")
        .filter(F.col("value") != 0)
    )
