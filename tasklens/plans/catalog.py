"""The catalogue of registered queries: each reads a folder of tables, most have a SQL text to check them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tasklens import constants as K
from tasklens.operators.canonical import broker_events, signal_events
from tasklens.operators.envelope import absorb_bad_events, quarantine_poison, route_event_types
from tasklens.operators.naming import carry_task_name, join_task_meta, with_task_name
from tasklens.sources.views import metadata, signals, view, with_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``oracle`` is DuckDB SQL in which ``{name}`` stands for a view."""

    def register(fn: Query) -> Query:
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = with_views(oracle)
        return fn

    return register


# --- Shared steps ---------------------------------------------------------------


def good_events(spark: SparkSession, folder: str, source: str = "raw_task_events") -> DataFrame:
    """Raw events that can be mapped, with their kind. Poison is cut before anything is filtered out."""
    return absorb_bad_events(route_event_types(quarantine_poison(view(spark, folder, source))))[0]


def named_events(spark: SparkSession, folder: str, source: str = "raw_task_events") -> DataFrame:
    return with_task_name(carry_task_name(good_events(spark, folder, source)))


def canonical(spark: SparkSession, folder: str, source: str = "raw_task_events", meta: bool = False) -> DataFrame:
    """Canonical broker events; ``meta`` joins the metadata that tags, redacts and rates them."""
    rows = named_events(spark, folder, source)
    return broker_events(join_task_meta(rows, metadata(spark, folder)) if meta else rows)


def canonical_signals(spark: SparkSession, folder: str, meta: DataFrame | None = None) -> DataFrame:
    return signal_events(signals(spark, folder), meta)


def joined(array: Column) -> Column:
    """A list as text, so that both engines show it alike."""
    return F.array_join(array, ";")


def shown(map_column: Column) -> Column:
    """A map as text, sorted by key."""
    entries = F.array_sort(F.map_entries(map_column))
    return joined(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("null")))))


# --- Shared SQL -----------------------------------------------------------------


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def scrubbed(expression: str) -> str:
    """The default text rules as DuckDB SQL."""
    for _name, pattern, replacement in K.TEXT_RULES:
        for n in "1234567":
            replacement = replacement.replace(f"${n}", f"\\{n}")
        pattern = pattern.replace("{", "{{").replace("}", "}}")
        expression = f"regexp_replace({expression}, {quoted(pattern)}, {quoted(replacement)}, 'g')"
    return expression


def cut(expression: str, limit: int) -> str:
    return (
        f"CASE WHEN length({expression}) > {limit} THEN '[... traceback truncated ...]' || chr(10) || "
        f"right({expression}, {limit}) ELSE {expression} END"
    )


def good_sql(source: str = "raw_task_events") -> str:
    return f"""first_bad AS (SELECT message_id AS m, min(pos) AS p FROM {{{source}}} WHERE poison GROUP BY message_id),
good AS (SELECT r.*, replace(type, 'task-', '') AS kind FROM {{{source}}} r LEFT JOIN first_bad b ON r.message_id = b.m
  WHERE (b.p IS NULL OR r.pos < b.p)
    AND type IN ('task-started', 'task-succeeded', 'task-failed', 'task-retried', 'task-revoked')
    AND NOT (type = 'task-succeeded' AND runtime IS NOT NULL AND try_cast(runtime AS double) IS NULL))"""


def named_sql(source: str = "raw_task_events") -> str:
    return f"""{good_sql(source)},
epochs AS (SELECT *, coalesce(sum(CASE WHEN kind IN ('succeeded', 'failed', 'revoked') THEN 1 ELSE 0 END)
    OVER (PARTITION BY uuid ORDER BY event_ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS epoch FROM good),
carried AS (SELECT *, coalesce(nullif(name, ''), last_value(CASE WHEN kind = 'started' THEN nullif(name, '') END IGNORE NULLS)
    OVER (PARTITION BY uuid, epoch ORDER BY event_ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS carried_name FROM epochs),
named AS (SELECT *, coalesce(carried_name, '<unknown:' || left(uuid, 8) || '>') AS task_name,
    CASE WHEN kind = 'succeeded' THEN CAST(trunc(try_cast(runtime AS double) * 1000) AS bigint) END AS runtime_ms FROM carried)"""


_REQUEST_ID = "coalesce(CASE WHEN has_request THEN request_id END, CASE WHEN has_request THEN request_task_id END, '')"
SIGNALS_SQL = f"""gated AS (SELECT *, CASE signal WHEN 'received' THEN 'received' WHEN 'prerun' THEN 'started' WHEN 'postrun' THEN 'succeeded'
      WHEN 'failure' THEN 'failed' WHEN 'retry' THEN 'retried' ELSE 'revoked' END AS kind,
    CASE WHEN signal IN ('received', 'revoked') THEN {_REQUEST_ID}
      WHEN signal = 'retry' THEN coalesce(nullif({_REQUEST_ID}, ''), kwargs_task_id, '') ELSE coalesce(task_id, '') END AS tid,
    CASE WHEN signal = 'received' AND has_delivery THEN routing_key END AS queue
  FROM {{signal_rows}}
  WHERE (signal = 'received' AND has_request) OR (signal = 'postrun' AND state = 'SUCCESS')
    OR (signal = 'failure' AND exception_type IS NOT NULL) OR signal IN ('prerun', 'retry', 'revoked')),
sig AS (SELECT *, coalesce(task, '<unknown:' || queue || ':' || nullif(left(tid, 8), '') || '>', '<unknown:' || queue || '>',
    '<unknown:' || nullif(left(tid, 8), '') || '>', '<unknown>') AS task_name FROM gated)"""
