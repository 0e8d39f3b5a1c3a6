"""Canonical events by kind, both capture paths together, and duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tasklens.operators import canonical as O
from tasklens.plans.catalog import (
    SIGNALS_SQL,
    canonical,
    canonical_signals,
    cut,
    joined,
    named_sql,
    query,
    scrubbed,
)
from tasklens.sources.views import metadata

_DETAILED = f"WITH {named_sql('detailed_events')}"
_BROKER = "'broker:' || event_id AS event_id, uuid AS task_id, kind, event_ts, 'broker' AS capture, task_name, CAST(NULL AS varchar) AS queue, hostname AS worker"


def _of_kind(spark, folder, kind):
    return O.of_kind(canonical(spark, folder, "detailed_events", meta=True), kind)


@query(
    "events_received",
    f"""WITH {SIGNALS_SQL}
SELECT 'signal:' || event_id AS event_id, tid AS task_id, kind, event_ts, 'signal' AS capture, task_name, queue, CAST(NULL AS varchar) AS worker,
  CASE WHEN args = '()' THEN '[]' WHEN args LIKE '(%' THEN '[' || replace(substr(args, 2, length(args) - 2), '''', '"') || ']' END AS args,
  CASE WHEN kwargs = '{{{{}}}}' THEN kwargs WHEN kwargs IS NOT NULL THEN '{{{{"user_id":"' || regexp_extract(kwargs, '([0-9]+)', 1) || '","password":"[REDACTED]"}}}}' END AS kwargs,
  nullif(parent_id, '') AS parent_task_id, nullif(root_id, '') AS root_task_id, m.tag AS tags, m.priority
FROM sig LEFT JOIN {{task_meta}} m USING (task_name) WHERE kind = 'received'""",
)
def events_received(spark, folder):
    events = canonical_signals(spark, folder, metadata(spark, folder))
    columns = [*O.COMMON, *O.PAYLOAD["received"], joined(F.col("tags")).alias("tags"), "priority"]
    return events.filter("kind = 'received'").select(*columns)


@query(
    "events_started",
    f"{_DETAILED} SELECT {_BROKER}, CAST(NULL AS varchar) AS args, CAST(NULL AS varchar) AS kwargs FROM named WHERE kind = 'started'",
)
def events_started(spark, folder):
    return _of_kind(spark, folder, "started")


@query(
    "events_succeeded",
    f"""{_DETAILED} SELECT {_BROKER.replace(' task_name,', ' n.task_name,')}, CASE WHEN m.redact_result THEN '[REDACTED]' ELSE {scrubbed('result')} END AS result, runtime_ms
FROM named n LEFT JOIN {{task_meta}} m ON n.task_name = m.task_name WHERE kind = 'succeeded'""",
)
def events_succeeded(spark, folder):
    return _of_kind(spark, folder, "succeeded")


@query(
    "events_failed",
    rf"""{_DETAILED} SELECT {_BROKER}, CASE WHEN regexp_matches(exception, '^[A-Za-z_]\w*(\.[A-Za-z_]\w*)*\(')
  THEN regexp_extract(exception, '^(?:[A-Za-z_]\w*\.)*([A-Za-z_]\w*)\(', 1) ELSE 'Exception' END AS exception,
  coalesce(exception, 'Unknown error') AS exception_message, {scrubbed(cut('traceback', 4096))} AS traceback FROM named WHERE kind = 'failed'""",
)
def events_failed(spark, folder):
    return _of_kind(spark, folder, "failed")


@query("events_retried", f"{_DETAILED} SELECT {_BROKER}, exception AS reason FROM named WHERE kind = 'retried'")
def events_retried(spark, folder):
    return _of_kind(spark, folder, "retried")


@query(
    "events_revoked",
    f"{_DETAILED} SELECT {_BROKER}, coalesce(terminated, false) AS terminated, signum, coalesce(expired, false) AS expired FROM named WHERE kind = 'revoked'",
)
def events_revoked(spark, folder):
    return _of_kind(spark, folder, "revoked")


def _both(spark, folder, owned_only):
    return O.unify_sources(canonical(spark, folder), canonical_signals(spark, folder), owned_only)


_BOTH = f"""WITH {named_sql()}, {SIGNALS_SQL},
both_ AS (SELECT 'broker:' || event_id AS event_id, uuid AS task_id, kind, event_ts, 'broker' AS capture FROM named
  UNION ALL SELECT 'signal:' || event_id, tid, kind, event_ts, 'signal' FROM sig)"""
_SHORT = ("event_id", "task_id", "kind", "event_ts", "capture")


@query("unify_sources", f"{_BOTH} SELECT * FROM both_ WHERE (capture = 'signal') = (kind = 'received')")
def unify_sources(spark, folder):
    return _both(spark, folder, True).select(*_SHORT)


_DEDUPED = (
    f"""{_BOTH},
counted AS (SELECT *, coalesce(nullif(task_id, ''), event_id) AS t, CAST(coalesce(sum(CASE WHEN kind = 'retried' THEN 1 ELSE 0 END)
  OVER (PARTITION BY coalesce(nullif(task_id, ''), event_id), capture ORDER BY event_ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bigint) AS attempt FROM both_),
ranked AS (SELECT *, row_number() OVER (PARTITION BY t, kind, attempt ORDER BY CASE WHEN (capture = 'signal') = (kind = 'received') THEN 0 ELSE 1 END, event_ts, event_id) AS r FROM counted)
SELECT event_id, task_id, kind, attempt, event_ts, capture FROM ranked WHERE r = 1"""
)


@query("dedupe_events", _DEDUPED)
def dedupe_events(spark, folder):
    return O.dedupe_transitions(_both(spark, folder, False)).select(*_SHORT, "attempt")


@query("dedupe_events_of_hot_tasks", _DEDUPED)
def dedupe_events_of_hot_tasks(spark, folder):
    """The same where a task may hold so few rows that the busier ones are cut up."""
    return O.dedupe_transitions(_both(spark, folder, False), key_row_budget=12).select(*_SHORT, "attempt")


@query("dedupe_resends", f"{_BOTH} SELECT * FROM both_")
def dedupe_resends(spark, folder):
    events = _both(spark, folder, False)
    again = events.filter(F.pmod(F.xxhash64("event_id"), F.lit(4)) == 0)
    return O.dedupe_resends(events.unionByName(again)).select(*_SHORT)
