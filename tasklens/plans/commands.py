"""Retry, purge and outcome planning."""

from __future__ import annotations

from pyspark.sql import functions as F

from tasklens.operators import planning as P
from tasklens.operators.state import queue_depths
from tasklens.plans.catalog import query
from tasklens.plans.scalars import ETA_SQL, NOW
from tasklens.sources.views import view


@query(
    "retry_candidates",
    """SELECT command_id, position, task_id FROM (SELECT *, row_number() OVER (PARTITION BY command_id ORDER BY position) AS r FROM {retry_requests}) x
WHERE r <= least(max_ids, 10000)""",
)
def retry_candidates(spark, folder):
    ids = view(spark, folder, "retry_requests").select("command_id", "position", "task_id", "max_ids")
    return P.retry_candidates(ids).select("command_id", "position", "task_id")


@query(
    "retry_requests",
    """SELECT c_custkey AS command_id, CASE WHEN n IS NULL THEN 'refused' ELSE 'accepted' END AS status,
  least(coalesce(n, 0), c_custkey % 4 * 3) AS requested, coalesce(n, 0) > c_custkey % 4 * 3 AS capped
FROM (SELECT DISTINCT o_orderkey AS c_custkey FROM orders) c LEFT JOIN (SELECT command_id, count(*) AS n FROM {retry_requests} GROUP BY command_id) t ON c_custkey = command_id""",
)
def retry_requests(spark, folder):
    commands = view(spark, folder, "orders").select(
        F.col("o_orderkey").alias("command_id"), (F.col("o_orderkey") % 4 * 3).alias("max_ids")
    )
    return P.retry_requests(commands, view(spark, folder, "retry_requests"))


_STORED = "regexp_matches(coalesce(supplied_name, ''), '^(<unknown.*|unknown|)$')"
_NAME = f"CASE WHEN NOT {_STORED} THEN supplied_name ELSE b.name END"


@query("retry_name", f"SELECT r.task_id, {_NAME} AS name FROM {{retry_requests}} r LEFT JOIN {{result_backend}} b ON r.task_id = b.task_id")
def retry_name(spark, folder):
    stored = view(spark, folder, "result_backend").select("task_id", F.col("name").alias("stored"))
    none = F.lit(None).cast("string")
    rows = view(spark, folder, "retry_requests").join(stored, "task_id", "left")
    return rows.select("task_id", P.retry_name(F.col("supplied_name"), F.col("stored"), none, none).alias("name"))


_REASON = f"""CASE WHEN {ETA_SQL} IS NOT NULL THEN 'eta ' || {ETA_SQL} WHEN {_NAME} IS NULL THEN 'name unresolved'
  WHEN coalesce(override_args, b.args) IS NULL OR coalesce(override_kwargs, b.kwargs) IS NULL THEN 'inputs unresolved' END"""


def _plan(spark, folder):
    requests = view(spark, folder, "retry_requests")
    backend = view(spark, folder, "result_backend").select("task_id", "name", "args", "kwargs")
    return P.retry_plan(requests, backend, F.lit(NOW), F.col("transport"))


@query(
    "retry_inputs",
    f"""SELECT r.task_id, {_REASON} AS reason FROM {{retry_requests}} r LEFT JOIN {{result_backend}} b ON r.task_id = b.task_id""",
)
def retry_inputs(spark, folder):
    return _plan(spark, folder).select("task_id", "reason")


@query(
    "retry_plan",
    f"""WITH decided AS (SELECT r.command_id, r.position, r.task_id, r.eta, r.priority_label, r.transport, {_REASON} AS reason, {_NAME} AS name,
  coalesce(override_args, b.args) AS args, coalesce(override_kwargs, b.kwargs) AS kwargs FROM {{retry_requests}} r LEFT JOIN {{result_backend}} b ON r.task_id = b.task_id)
SELECT command_id, position, task_id, CASE WHEN reason IS NULL THEN 'accepted' ELSE 'refused' END AS status, reason,
  CASE WHEN reason IS NULL THEN name END AS name, CASE WHEN reason IS NULL THEN args END AS args, CASE WHEN reason IS NULL THEN kwargs END AS kwargs,
  CASE WHEN reason IS NULL THEN eta END AS eta,
  CASE WHEN reason IS NULL THEN CASE lower(trim(priority_label)) WHEN 'critical' THEN CASE WHEN transport = 'redis' THEN 0 ELSE 9 END
    WHEN 'high' THEN CASE WHEN transport = 'redis' THEN 3 ELSE 6 END WHEN 'normal' THEN CASE WHEN transport = 'redis' THEN 6 ELSE 3 END
    WHEN 'low' THEN CASE WHEN transport = 'redis' THEN 9 ELSE 0 END END END AS priority FROM decided""",
)
def retry_plan(spark, folder):
    return _plan(spark, folder)


_BREAKER = """runs AS (SELECT *, sum(CASE WHEN outcome = 'success' THEN 1 ELSE 0 END) OVER w AS run, row_number() OVER w AS r FROM {command_log}
  WINDOW w AS (PARTITION BY batch_id ORDER BY event_ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
streaks AS (SELECT *, sum(CASE WHEN outcome = 'indeterminate' THEN 1 ELSE 0 END)
  OVER (PARTITION BY batch_id, run ORDER BY event_ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS streak FROM runs),
breaks AS (SELECT batch_id AS b, min(r) AS cut FROM streaks WHERE streak >= 3 GROUP BY batch_id),
final AS (SELECT *, CASE WHEN r > cut THEN 'skipped' ELSE outcome END AS final_outcome FROM streaks LEFT JOIN breaks ON batch_id = b)"""


@query("circuit_break", f"WITH {_BREAKER} SELECT batch_id, event_id, outcome, final_outcome FROM final")
def circuit_break(spark, folder):
    return P.circuit_break(view(spark, folder, "command_log")).select(
        "batch_id", "event_id", "outcome", "final_outcome"
    )


@query(
    "retry_summary",
    f"""WITH {_BREAKER}
SELECT batch_id, count(*) FILTER (r <= 9) AS requested, count(*) FILTER (r <= 9 AND final_outcome = 'success') AS succeeded,
  count(*) FILTER (r <= 9 AND final_outcome IN ('failed', 'indeterminate')) AS failed, count(*) FILTER (r <= 9 AND final_outcome = 'skipped') AS skipped,
  coalesce(min(cut) <= 9, false) AS circuit_broken, count(*) > 9 AS capped FROM final GROUP BY batch_id""",
)
def retry_summary(spark, folder):
    log = view(spark, folder, "command_log").withColumn("task_id", F.col("event_id").cast("string"))
    return P.retry_summary(log, cap=9)


_PURGE_LIMIT = 3700
_DECIDED = f"""depths AS (SELECT k.queue AS q, count(l_orderkey) AS depth FROM (SELECT 'q' || unnest(range(10)) AS queue) k LEFT JOIN {{pending_messages}} p ON k.queue = p.queue GROUP BY 1),
decided AS (SELECT request_id, queue, depth AS depth_before, force, CASE WHEN force THEN NULL WHEN confirm_token IS NULL THEN 'no confirm token' WHEN depth IS NULL THEN 'depth unknown'
  WHEN depth > {_PURGE_LIMIT} THEN 'depth over threshold' WHEN confirm_token <> expected_token THEN 'confirm token mismatch' END AS reason FROM {{purge_requests}} LEFT JOIN depths ON queue = q)"""


def _decisions(spark, folder):
    # Queues q0 to q9 are the known ones.
    known = view(spark, folder, "supplier").select(F.concat(F.lit("q"), F.col("s_suppkey") % 10).alias("queue"))
    depths = queue_depths(view(spark, folder, "pending_messages"), known)
    return P.purge_decision(view(spark, folder, "purge_requests"), depths, _PURGE_LIMIT)


@query(
    "purge_decision",
    f"WITH {_DECIDED} SELECT request_id, queue, depth_before, reason IS NULL AS allowed, reason, force AS audit FROM decided",
)
def purge_decision(spark, folder):
    return _decisions(spark, folder)


@query(
    "purge_effect",
    f"""WITH {_DECIDED}
SELECT d.queue, max(depth_before) AS depth_before, coalesce(max(n), 0) AS purged FROM decided d
LEFT JOIN (SELECT queue AS q, count(*) AS n FROM {{pending_messages}} GROUP BY 1) c ON d.queue = c.q WHERE reason IS NULL GROUP BY d.queue""",
)
def purge_effect(spark, folder):
    return P.purge_effect(view(spark, folder, "pending_messages"), _decisions(spark, folder))


@query(
    "surviving_messages",
    f"WITH {_DECIDED} SELECT l_orderkey, l_linenumber, queue FROM {{pending_messages}} WHERE queue NOT IN (SELECT queue FROM decided WHERE reason IS NULL)",
)
def surviving_messages(spark, folder):
    return P.surviving_messages(view(spark, folder, "pending_messages"), _decisions(spark, folder))


@query(
    "command_outcomes",
    "SELECT 'retry' || batch_id % 3 AS action, outcome, count(*) AS n FROM {command_log} GROUP BY 1, 2",
)
def command_outcomes(spark, folder):
    log = view(spark, folder, "command_log").select(
        F.concat(F.lit("retry"), F.col("batch_id") % 3).alias("action"),
        F.when(F.col("outcome") == "success", "success").otherwise("failed").alias("status"),
        (F.col("outcome") == "indeterminate").alias("indeterminate"),
    )
    return P.command_outcomes(log)
