"""Questions over canonical events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tasklens.operators import analytics as A
from tasklens.operators.canonical import broker_events, unify_sources
from tasklens.operators.naming import join_task_meta
from tasklens.plans.catalog import (
    SIGNALS_SQL,
    canonical,
    canonical_signals,
    named_events,
    named_sql,
    query,
)
from tasklens.sources.views import metadata, view

_NAMED = f"WITH {named_sql()}"


def _with_meta(spark, folder):
    return broker_events(join_task_meta(named_events(spark, folder), metadata(spark, folder)))


@query(
    "task_latest_state",
    f"""{_NAMED} SELECT uuid AS task_id, arg_max(kind, (event_ts, event_id)) AS kind, min(event_ts) AS first_ts, max(event_ts) AS last_ts, count(*) AS n_events,
  arg_max(hostname, (event_ts, event_id)) AS worker, CAST(NULL AS varchar) AS queue, arg_max(task_name, (event_ts, event_id)) AS task_name FROM named GROUP BY uuid""",
)
def task_latest_state(spark, folder):
    return A.task_latest_state(canonical(spark, folder))


@query(
    "task_runtime_stats",
    f"""{_NAMED} SELECT task_name, count(*) AS n, round(avg(runtime_ms), 3) AS avg_ms, min(runtime_ms) AS min_ms, max(runtime_ms) AS max_ms,
  round(quantile_cont(runtime_ms, 0.5), 3) AS p50_ms, round(quantile_cont(runtime_ms, 0.95), 3) AS p95_ms FROM named WHERE runtime_ms IS NOT NULL GROUP BY task_name""",
)
def task_runtime_stats(spark, folder):
    stats = A.task_runtime_stats(canonical(spark, folder))
    return stats.withColumns({c: F.round(c, 3) for c in ("avg_ms", "p50_ms", "p95_ms")})


@query("task_runtime_sketch")
def task_runtime_sketch(spark, folder):
    return A.task_runtime_sketch(canonical(spark, folder))


@query(
    "task_phase_times",
    f"""WITH {named_sql()}, {SIGNALS_SQL},
events_ AS (SELECT uuid AS task_id, kind, event_ts FROM named UNION ALL SELECT tid, kind, event_ts FROM sig WHERE kind = 'received'),
phases AS (SELECT task_id, min(event_ts) FILTER (kind = 'received') AS received_ts, min(event_ts) FILTER (kind = 'started') AS started_ts,
  min(event_ts) FILTER (kind IN ('succeeded', 'failed', 'revoked')) AS ended_ts FROM events_ GROUP BY task_id)
SELECT *, date_diff('microsecond', received_ts, started_ts) AS wait_us, date_diff('microsecond', started_ts, ended_ts) AS run_us FROM phases""",
)
def task_phase_times(spark, folder):
    return A.task_phase_times(unify_sources(canonical(spark, folder), canonical_signals(spark, folder)))


@query(
    "deadline_breaches",
    f"""{_NAMED} SELECT 'broker:' || event_id AS event_id, uuid AS task_id, n.task_name, runtime_ms, expected_duration_ms, deadline_ms,
  runtime_ms > expected_duration_ms AS over_expected, runtime_ms > deadline_ms AS over_deadline
FROM named n JOIN {{task_meta}} m ON n.task_name = m.task_name WHERE runtime_ms > expected_duration_ms OR runtime_ms > deadline_ms""",
)
def deadline_breaches(spark, folder):
    return A.deadline_breaches(_with_meta(spark, folder))


_CLASS = r"""CASE WHEN regexp_matches(exception, '^[A-Za-z_]\w*(\.[A-Za-z_]\w*)*\(')
  THEN regexp_extract(exception, '^(?:[A-Za-z_]\w*\.)*([A-Za-z_]\w*)\(', 1) ELSE 'Exception' END"""
_FAILED = f"{_NAMED}, failed AS (SELECT {_CLASS} AS exception, task_name, hostname AS worker FROM named WHERE kind = 'failed')"


@query(
    "failure_breakdown",
    f"{_FAILED} SELECT exception, task_name, worker, count(*) AS n, grouping(exception, task_name, worker) AS level FROM failed GROUP BY ROLLUP (exception, task_name, worker)",
)
def failure_breakdown(spark, folder):
    return A.failure_breakdown(canonical(spark, folder))


@query(
    "failure_cube",
    f"{_FAILED} SELECT exception, worker, count(*) AS n, grouping(exception, worker) AS level FROM failed GROUP BY CUBE (exception, worker)",
)
def failure_cube(spark, folder):
    return A.failure_cube(canonical(spark, folder))


@query(
    "tag_counts",
    f"{_NAMED} SELECT m.tag, count(*) AS n FROM named n JOIN {{task_meta}} m ON n.task_name = m.task_name GROUP BY m.tag",
)
def tag_counts(spark, folder):
    return A.tag_counts(_with_meta(spark, folder))


@query(
    "task_tree",
    """WITH tree AS (SELECT task_id, root_task_id, 0 AS depth FROM {lineage} WHERE parent_task_id IS NULL
  UNION ALL SELECT l.task_id, l.root_task_id, t.depth + 1 FROM {lineage} l JOIN tree t ON l.parent_task_id = t.task_id)
SELECT root_task_id, count(*) AS size, CAST(max(depth) AS bigint) AS depth FROM tree GROUP BY root_task_id""",
)
def task_tree(spark, folder):
    return A.task_tree(view(spark, folder, "lineage"))


@query(
    "priority_mix",
    """SELECT coalesce(queue, 'none') AS queue, count(*) FILTER (priority = 'critical') AS critical, count(*) FILTER (priority = 'high') AS high,
  count(*) FILTER (priority = 'normal') AS normal, count(*) FILTER (priority = 'low') AS low
FROM (SELECT CASE WHEN has_request AND has_delivery THEN routing_key END AS queue, m.priority FROM {signal_rows} s LEFT JOIN {task_meta} m ON s.task = m.task_name
  WHERE s.signal = 'received' AND has_request) x GROUP BY 1""",
)
def priority_mix(spark, folder):
    received = canonical_signals(spark, folder, metadata(spark, folder)).filter("kind = 'received'")
    return A.priority_mix(received.withColumn("queue", F.coalesce("queue", F.lit("none"))))


@query(
    "retry_chains",
    f"""{_NAMED} SELECT 'broker:' || event_id AS event_id, uuid AS task_id, event_ts, row_number() OVER w AS attempt,
  date_diff('microsecond', lag(event_ts) OVER w, event_ts) AS gap_us FROM named WHERE kind = 'retried' WINDOW w AS (PARTITION BY uuid ORDER BY event_ts, 'broker:' || event_id)""",
)
def retry_chains(spark, folder):
    return A.retry_chains(canonical(spark, folder))


@query(
    "worker_load",
    f"""{_NAMED} SELECT hostname AS worker, count(*) AS n_events, count(DISTINCT uuid) AS n_tasks, dense_rank() OVER (ORDER BY count(*) DESC) AS load_rank FROM named GROUP BY hostname""",
)
def worker_load(spark, folder):
    return A.worker_load(canonical(spark, folder))


@query("worker_load_sketch")
def worker_load_sketch(spark, folder):
    return A.worker_load(canonical(spark, folder), approximate=True)
