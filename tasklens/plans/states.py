"""State reconciliation and fleet snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from tasklens import constants as K
from tasklens.functions.control import canonical_state
from tasklens.operators import state as S
from tasklens.operators.analytics import task_latest_state
from tasklens.plans.catalog import canonical, cut, named_sql, query, quoted
from tasklens.sources.views import view


def _state_sql(state: str) -> str:
    return f"""CASE WHEN {state} IN ('PENDING', 'RECEIVED', 'RETRY') THEN 'pending' WHEN {state} = 'STARTED' THEN 'started'
  WHEN {state} = 'SUCCESS' THEN 'success' WHEN {state} IN ('FAILURE', 'REVOKED') THEN 'failure' ELSE 'unknown' END"""


@query("canonical_state", f"SELECT task_id, state, {_state_sql('state')} AS engine_state FROM {{result_backend}}")
def states(spark, folder):
    return view(spark, folder, "result_backend").select(
        "task_id", "state", canonical_state(F.col("state")).alias("engine_state")
    )


@query(
    "reconcile_record",
    f"""SELECT b.task_id, {_state_sql('b.state')} AS engine_state, CASE WHEN b.state IN ('SUCCESS', 'FAILURE', 'REVOKED') THEN b.date_done END AS finished_at,
  CASE WHEN b.state IN ('FAILURE', 'REVOKED') THEN {cut("nullif(t.traceback, '')", 2000)} END AS exception
FROM {{result_backend}} b LEFT JOIN {{tracebacks}} t ON b.task_id = CAST(t.doc_id AS varchar)""",
)
def reconcile_record(spark, folder):
    stored = view(spark, folder, "result_backend")
    traces = view(spark, folder, "tracebacks").select(F.col("doc_id").cast("string").alias("task_id"), "traceback")
    return S.reconcile_record(stored.join(traces, "task_id", "left"))


@query(
    "state_drift",
    f"""WITH {named_sql()},
seen AS (SELECT uuid AS task_id, CASE arg_max(kind, (event_ts, event_id)) WHEN 'started' THEN 'started' WHEN 'succeeded' THEN 'success'
  WHEN 'failed' THEN 'failure' WHEN 'revoked' THEN 'failure' ELSE 'pending' END AS event_state FROM named GROUP BY uuid),
stored AS (SELECT task_id AS s, {_state_sql('state')} AS stored_state FROM {{stored_states}})
SELECT coalesce(task_id, s) AS task_id, event_state, stored_state, CASE WHEN s IS NULL THEN 'events only' WHEN task_id IS NULL THEN 'stored only'
  WHEN event_state = stored_state THEN 'match' ELSE 'drift' END AS verdict FROM seen FULL JOIN stored ON task_id = s""",
)
def state_drift(spark, folder):
    latest = task_latest_state(canonical(spark, folder))
    return S.state_drift(latest, view(spark, folder, "stored_states"))


_KNOWN = """known AS (SELECT app, unnest(CASE WHEN queue_list <> '' THEN string_split(queue_list, ',') ELSE [coalesce(task_default_queue, 'celery')] END) AS queue FROM {queue_conf})"""


def _conf(spark, folder):
    lists = F.when(F.col("queue_list") != "", F.split("queue_list", ",")).when(
        F.col("queue_list") == "", F.array().cast("array<string>")
    )
    return view(spark, folder, "queue_conf").withColumn("task_queues", lists)


@query("known_queues", f"WITH {_KNOWN} SELECT app, queue FROM known")
def known_queues(spark, folder):
    return S.known_queues(_conf(spark, folder))


@query(
    "queue_depths",
    f"""WITH {_KNOWN}, depths AS (SELECT queue AS q, count(*) AS n FROM {{pending_messages}} GROUP BY queue)
SELECT queue, coalesce(n, 0) AS depth FROM (SELECT DISTINCT queue FROM known) k LEFT JOIN depths ON queue = q""",
)
def queue_depths(spark, folder):
    return S.queue_depths(view(spark, folder, "pending_messages"), S.known_queues(_conf(spark, folder)))


@query(
    "worker_details",
    """WITH conf AS (SELECT hostname, string_agg(conf_key || '=' || coalesce(conf_value, 'null'), ';' ORDER BY conf_key) AS conf FROM {workers}
  WHERE conf_key IN ('task_acks_late', 'task_time_limit', 'worker_concurrency') GROUP BY hostname)
SELECT h.s_name AS hostname, CASE WHEN s_suppkey % 2 = 0 THEN 'total ' || s_suppkey END AS stats, CASE WHEN s_suppkey % 3 = 0 THEN 'task ' || s_suppkey END AS active,
  CASE WHEN s_suppkey % 5 = 0 THEN 'q' || s_nationkey END AS active_queues, CASE WHEN s_suppkey % 7 = 0 THEN 'app.t' || s_suppkey END AS registered,
  CASE WHEN s_suppkey % 11 <> 0 THEN conf END AS conf
FROM supplier h JOIN conf ON h.s_name = conf.hostname WHERE s_suppkey % 2 = 0 OR s_suppkey % 3 = 0 OR s_suppkey % 5 = 0 OR s_suppkey % 7 = 0 OR s_suppkey % 11 <> 0""",
)
def worker_details(spark, folder):
    supplier = view(spark, folder, "supplier")
    key = F.col("s_suppkey")

    def reply(divisor, text):
        return supplier.filter(key % divisor == 0).select(F.col("s_name").alias("hostname"), text.alias("reply"))

    settings = S.worker_conf(view(spark, folder, "workers"))
    pair = F.concat("conf_key", F.lit("="), F.coalesce("conf_value", F.lit("null")))
    # At most one row per allowed setting and worker.
    conf = settings.groupBy("hostname").agg(F.array_join(F.array_sort(F.collect_list(pair)), ";").alias("reply"))
    answered = supplier.filter(key % 11 != 0).select(F.col("s_name").alias("hostname"))
    return S.worker_details(
        {
            "stats": reply(2, F.concat(F.lit("total "), key)),
            "active": reply(3, F.concat(F.lit("task "), key)),
            "active_queues": reply(5, F.concat(F.lit("q"), F.col("s_nationkey"))),
            "registered": reply(7, F.concat(F.lit("app.t"), key)),
            "conf": conf.join(answered, "hostname", "left_semi"),
        }
    )


_ALLOWED = ", ".join(quoted(k) for k in K.WORKER_CONF_KEYS)


@query("worker_conf", f"SELECT hostname, conf_key, conf_value FROM {{workers}} WHERE conf_key IN ({_ALLOWED})")
def worker_conf(spark, folder):
    return S.worker_conf(view(spark, folder, "workers"))


@query(
    "recycle_limits",
    """WITH limits AS (SELECT hostname, coalesce(max_tasks_per_child, worker_max_tasks_per_child) AS t, coalesce(max_memory_per_child, worker_max_memory_per_child) AS m
  FROM {pools} WHERE has_controller AND pool LIKE '%prefork%')
SELECT hostname, 'worker_max_tasks_per_child' AS setting, CAST(t AS bigint) AS value FROM limits WHERE t <> 0
UNION ALL SELECT hostname, 'worker_max_memory_per_child', CAST(m AS bigint) FROM limits WHERE m <> 0""",
)
def recycle_limits(spark, folder):
    return S.recycle_limits(view(spark, folder, "pools"))
