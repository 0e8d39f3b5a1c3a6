"""The canonical event: one wide row for every kind of transition, from either capture path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tasklens import constants as K
from tasklens.functions.control import lookup
from tasklens.functions.names import placeholder_name, present
from tasklens.functions.payload import (
    coerce_args,
    coerce_kwargs,
    flag,
    runtime_ms,
    scrub_args,
    scrub_kwargs,
    scrub_result,
)
from tasklens.functions.text import (
    exception_class,
    exception_message,
    first_traceback,
    retry_reason,
    scrub_text,
    tail,
)
from tasklens.operators.envelope import gate_signals, request_queue, signal_task_id
from tasklens.operators.naming import has_tags, join_task_meta
from tasklens.operators.ordered import Running, running
from tasklens.schemas import CANONICAL_EVENT, TASK_META

_META = ("redact_kwargs", "keep_kwargs", "redact_result", "tags", "priority", "expected_duration_ms", "deadline_ms")

COMMON = ("event_id", "task_id", "kind", "event_ts", "capture", "task_name", "queue", "worker")
PAYLOAD = {
    "received": ("args", "kwargs", "parent_task_id", "root_task_id"),
    "started": ("args", "kwargs"),
    "succeeded": ("result", "runtime_ms"),
    "failed": ("exception", "exception_message", "traceback"),
    "retried": ("reason",),
    "revoked": ("terminated", "signum", "expired"),
}


def _column(df: DataFrame, name: str, dtype: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


def _conform(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    schema = StructType.fromDDL(CANONICAL_EVENT)
    return df.select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    )


def _metadata(df: DataFrame) -> dict[str, Column]:
    types = {f.name: f.dataType.simpleString() for f in StructType.fromDDL(TASK_META)}
    return {name: _column(df, name, types[name]) for name in _META}


def broker_events(df: DataFrame) -> DataFrame:
    """Routed, named broker rows (``kind``, ``task_name``) as canonical events.

    All kinds are shaped in one projection; the metadata columns are used where ``df`` has them.
    """
    meta = _metadata(df)
    message = exception_message(_column(df, "exception"))

    def only(kind: str, value: Column) -> Column:
        return F.when(F.col("kind") == kind, value)

    return _conform(
        df,
        {
            "event_id": F.concat(F.lit("broker:"), F.col("event_id").cast("string")),
            "engine": F.lit(K.ENGINE),
            "task_id": F.coalesce("uuid", F.lit("")),
            "kind": F.col("kind"),
            "event_ts": F.col("event_ts"),
            "ingest_ts": _column(df, "ingest_ts", "timestamp_ntz"),
            "capture": F.lit("broker"),
            "task_name": F.col("task_name"),
            "worker": F.col("hostname"),
            "tags": has_tags(meta["tags"]),
            "priority": meta["priority"],
            "expected_duration_ms": meta["expected_duration_ms"],
            "deadline_ms": meta["deadline_ms"],
            "result": only("succeeded", scrub_result(_column(df, "result"), meta["redact_result"])),
            "runtime_ms": only("succeeded", runtime_ms(F.col("runtime"))),
            "exception": only("failed", exception_class(message)),
            "exception_message": only("failed", scrub_text(message)),
            "traceback": only("failed", scrub_text(tail(_column(df, "traceback"), K.EVENT_TRACEBACK_CHARS))),
            "reason": only("retried", scrub_text(_column(df, "exception"))),
            "terminated": only("revoked", flag(_column(df, "terminated", "boolean"))),
            "signum": only("revoked", _column(df, "signum", "int")),
            "expired": only("revoked", flag(_column(df, "expired", "boolean"))),
        },
    )


def signal_events(df: DataFrame, meta: DataFrame | None = None) -> DataFrame:
    """Signal rows as canonical events; these carry no worker, and only received ones carry a queue."""
    received, started = F.col("kind") == "received", F.col("kind") == "started"
    df = gate_signals(df).withColumns(
        {
            "kind": lookup(F.col("signal"), K.SIGNAL_KINDS),
            "_id": signal_task_id(),
        }
    )
    df = df.withColumn("queue", F.when(received, request_queue()))
    own_name = F.when(received, F.col("request.task")).otherwise(F.col("task"))
    df = df.withColumn("task_name", placeholder_name(own_name, F.col("_id"), F.col("queue")))
    if meta is not None:
        df = join_task_meta(df, meta)
    m = _metadata(df)
    args = coerce_args(F.when(received, F.col("request.args")).when(started, F.col("args")))
    kwargs = coerce_kwargs(F.when(received, F.col("request.kwargs")).when(started, F.col("kwargs")))
    trace = first_traceback(F.col("einfo_traceback"), F.col("traceback"), F.col("exception_traceback"))

    def only(kind: str, value: Column) -> Column:
        return F.when(F.col("kind") == kind, value)

    return _conform(
        df,
        {
            "event_id": F.concat(F.lit("signal:"), F.col("event_id").cast("string")),
            "engine": F.lit(K.ENGINE),
            "task_id": F.col("_id"),
            "kind": F.col("kind"),
            "event_ts": F.col("event_ts"),
            "ingest_ts": _column(df, "ingest_ts", "timestamp_ntz"),
            "capture": F.lit("signal"),
            "task_name": F.col("task_name"),
            "queue": F.col("queue"),
            "tags": has_tags(m["tags"]),
            "priority": m["priority"],
            "expected_duration_ms": m["expected_duration_ms"],
            "deadline_ms": m["deadline_ms"],
            "args": scrub_args(args, m["keep_kwargs"]),
            "kwargs": F.to_json(scrub_kwargs(kwargs, m["redact_kwargs"], m["keep_kwargs"]), {"ignoreNullFields": "false"}),
            "parent_task_id": only("received", present(F.col("request.parent_id"))),
            "root_task_id": only("received", present(F.col("request.root_id"))),
            "result": only("succeeded", scrub_result(F.col("retval"), m["redact_result"])),
            "exception": only("failed", F.col("exception_type")),
            "exception_message": only("failed", scrub_text(F.col("exception_message"))),
            "traceback": only("failed", scrub_text(tail(trace, K.EVENT_TRACEBACK_CHARS))),
            "reason": only("retried", scrub_text(retry_reason(F.col("reason"), F.col("einfo")))),
            "terminated": only("revoked", flag(F.col("terminated"))),
            "signum": only("revoked", F.col("signum")),
            "expired": only("revoked", flag(F.col("expired"))),
        },
    )


def of_kind(events: DataFrame, kind: str) -> DataFrame:
    """The events of one kind, with the columns that kind carries."""
    return events.filter(F.col("kind") == kind).select(*COMMON, *PAYLOAD[kind])


def owns(capture: Column, kind: Column) -> Column:
    """True where a capture path is the owner of a kind: signals of received, the broker of the rest."""
    return (capture == "signal") == (kind == "received")


def unify_sources(broker: DataFrame, signals: DataFrame, owned_only: bool = True) -> DataFrame:
    """Both capture paths as one table. ``owned_only=False`` keeps the copies a single-process pool yields."""
    both = broker.unionByName(signals, allowMissingColumns=True)
    return both.filter(owns(F.col("capture"), F.col("kind"))) if owned_only else both


def dedupe_resends(events: DataFrame) -> DataFrame:
    """One row per event id."""
    return events.dropDuplicates(["event_id"])


def with_attempt(events: DataFrame, key_row_budget: int | None = None) -> DataFrame:
    """Add ``attempt``: how many retries of the task the event's own capture path reported before it.

    Events without a task id belong to no task, so each stands alone.
    """
    def retries(capture: str) -> Running:
        hit = (F.col("kind") == "retried") & (F.col("capture") == capture)
        return Running(f"_{capture}", F.when(hit, 1).otherwise(0), "sum", inclusive=False)

    keyed = events.withColumn("_task", F.coalesce(present(F.col("task_id")), F.col("event_id")))
    counted = running(
        keyed, ["_task"], ("event_ts", "event_id"), [[retries("broker"), retries("signal")]], key_row_budget
    )
    own = F.when(F.col("capture") == "signal", F.col("_signal")).otherwise(F.col("_broker"))
    return counted.withColumn("attempt", own).drop("_broker", "_signal")


def dedupe_transitions(events: DataFrame, key_row_budget: int | None = None) -> DataFrame:
    """One row per transition (task, kind, attempt), preferring the capture path that owns the kind.

    Ordinary tasks are ranked where the attempt count left them, so both windows share one shuffle. Where a hot task
    was cut up, Spark pushes the rank filter below the next shuffle, and each task sends one row per group at most.
    """
    best = W.partitionBy("_task", "kind", "attempt").orderBy(
        F.when(owns(F.col("capture"), F.col("kind")), 0).otherwise(1), "event_ts", "event_id"
    )
    return (
        with_attempt(events, key_row_budget)
        .withColumn("_rank", F.row_number().over(best))
        .filter(F.col("_rank") <= 1)
        .drop("_rank", "_task")
    )
