"""Sources, sinks and envelope handling."""

from __future__ import annotations

from pyspark.sql import functions as F

from tasklens import constants as K
from tasklens.operators import envelope as E
from tasklens.operators.registry import candidate_files, default_queue, runtime_registry
from tasklens.operators.state import queue_depths, reconcile_record, worker_conf, worker_details
from tasklens.plans.catalog import canonical, named_sql, query
from tasklens.session import new_folder
from tasklens.sources import readers
from tasklens.sources.views import signals, view
from tasklens.streaming import runs

_RAW = "event_id, event_ts, message_id, pos, uuid, type, name, hostname, runtime, exception, poison"


# Payload fields that no kind of these events carries: what is read back must be what was written.
_PAYLOAD = {
    "args": "concat('[', CAST(pos AS varchar(20)), ']')",
    "kwargs": "CASE WHEN pos % 2 = 0 THEN concat('k=', uuid) END",
    "queue": "CASE WHEN pos < 3 THEN concat('q', CAST(pos AS varchar(20))) END",
}


@query(
    "read_task_events",
    f"SELECT {_RAW}, {', '.join(f'{value} AS {name}' for name, value in _PAYLOAD.items())}, "
    "result, traceback, terminated, signum, expired FROM {detailed_events}",
)
def read_task_events(spark, folder):
    path = new_folder(spark, "events-json")
    rows = view(spark, folder, "detailed_events")
    readers.write_json(rows.withColumns({name: F.expr(value) for name, value in _PAYLOAD.items()}), path)
    return readers.read_task_events(spark, path, "json")


@query("stream_task_events", f"SELECT {_RAW} FROM {{raw_task_events}}")
def stream_task_events(spark, folder):
    return runs.append_all(runs.stream_view(spark, folder, "raw_task_events"), "arrivals")


@query(
    "read_signal_events",
    "SELECT signal, has_request, count(*) AS n, count(DISTINCT task_id) AS n_ids FROM {signal_rows} GROUP BY signal, has_request",
)
def read_signal_events(spark, folder):
    path = new_folder(spark, "signals")
    signals(spark, folder).write.parquet(path)
    rows = readers.read_signal_events(spark, path)
    per_id = rows.groupBy("signal", F.col("request").isNotNull().alias("has_request"), "task_id").agg(
        F.count("*").alias("_n")
    )
    return per_id.groupBy("signal", "has_request").agg(
        F.sum("_n").alias("n"), F.count("task_id").alias("n_ids")
    )


@query(
    "read_registry_snapshot",
    "SELECT name, nullif(queue, '') AS queue, seq FROM {registry} WHERE name NOT LIKE 'celery.%'",
)
def read_registry_snapshot(spark, folder):
    rows = runtime_registry(view(spark, folder, "registry"))
    return rows.select("name", default_queue(F.col("queue"), F.lit(None).cast("string")).alias("queue"), "seq")


@query(
    "scan_source_files",
    """SELECT path, length FROM {source_files}
WHERE length <= 2097152 AND (file IN ('tasks.py', 'celery.py', 'tasks/__init__.py', 'tasks/mail.py'))""",
)
def scan_source_files(spark, folder):
    files = view(spark, folder, "source_files")
    roots = files.select(F.regexp_extract("path", "^(.*/app[0-9]+)/", 1).alias("root")).distinct()
    return candidate_files(files, roots).select("path", "length")


@query(
    "read_result_backend",
    """SELECT task_id, CASE WHEN state IN ('PENDING', 'RECEIVED', 'RETRY') THEN 'pending' WHEN state = 'STARTED' THEN 'started'
    WHEN state = 'SUCCESS' THEN 'success' WHEN state IN ('FAILURE', 'REVOKED') THEN 'failure' ELSE 'unknown' END AS engine_state,
  CASE WHEN state IN ('SUCCESS', 'FAILURE', 'REVOKED') THEN date_done END AS finished_at, name, args, kwargs FROM {result_backend}""",
)
def read_result_backend(spark, folder):
    stored = view(spark, folder, "result_backend")
    return reconcile_record(stored.withColumn("traceback", F.lit(None).cast("string")), ("name", "args", "kwargs")).drop("exception")


@query(
    "read_worker_snapshots",
    """SELECT hostname, max(CASE WHEN conf_key = 'worker_concurrency' THEN conf_value END) AS stats,
  CAST(NULL AS varchar) AS active, CAST(NULL AS varchar) AS active_queues, CAST(NULL AS varchar) AS registered,
  count(CASE WHEN conf_key IN ('task_acks_late', 'task_time_limit', 'worker_concurrency') THEN 1 END) || ' settings' AS conf
FROM {workers} GROUP BY hostname""",
)
def read_worker_snapshots(spark, folder):
    rows = view(spark, folder, "workers")
    stats = rows.filter("conf_key = 'worker_concurrency'").select("hostname", F.col("conf_value").alias("reply"))
    conf = worker_conf(rows).groupBy("hostname").agg(F.concat(F.count("*"), F.lit(" settings")).alias("reply"))
    return worker_details({"stats": stats, "conf": conf})


@query(
    "read_queue_depths",
    "SELECT queue, count(*) AS depth FROM {pending_messages} GROUP BY queue",
)
def read_queue_depths(spark, folder):
    return view(spark, folder, "pending_messages").groupBy("queue").agg(F.count("*").alias("depth"))


@query(
    "write_events",
    f"""WITH {named_sql('detailed_events')}
SELECT CAST(CAST(event_ts AS date) AS varchar) AS event_date, kind, count(*) AS n, count(runtime_ms) AS n_runtimes,
  count(CASE WHEN kind = 'succeeded' AND (result IS NOT NULL OR m.redact_result) THEN 1 END) AS n_results,
  count(CASE WHEN kind = 'succeeded' AND m.redact_result THEN 1 END) AS n_redacted, min(n.task_name) AS first_name, max(m.tag) AS last_tag
FROM named n LEFT JOIN {{task_meta}} m ON n.task_name = m.task_name GROUP BY 1, 2""",
)
def write_events(spark, folder):
    path = new_folder(spark, "canonical")
    readers.write_events(canonical(spark, folder, "detailed_events", meta=True), path)
    return (
        spark.read.parquet(path)
        .groupBy(F.col("event_date").cast("string").alias("event_date"), "kind")
        .agg(
            F.count("*").alias("n"),
            F.count("runtime_ms").alias("n_runtimes"),
            F.count("result").alias("n_results"),
            F.count_if(F.col("result") == K.REDACTED).alias("n_redacted"),
            F.min("task_name").alias("first_name"),
            F.max(F.get("tags", F.lit(0))).alias("last_tag"),
        )
    )


@query(
    "explode_envelopes",
    """WITH items AS (
  SELECT message_id, 0 AS pos, json(body) AS item FROM {envelopes} WHERE message_id % 5 = 0
  UNION ALL SELECT message_id, i.pos, json_extract(json(ltrim(body)), '$[' || i.pos || ']') FROM {envelopes},
    (SELECT unnest([0, 1, 2]) AS pos) i WHERE message_id % 5 <> 0 AND i.pos < json_array_length(json(ltrim(body))))
SELECT message_id, pos, item->>'$.type' AS type, item->>'$.uuid' AS uuid, item->>'$.name' AS name,
  item->>'$.hostname' AS hostname, json_type(item) <> 'OBJECT' AS poison FROM items""",
)
def explode_envelopes(spark, folder):
    rows = E.explode_envelopes(view(spark, folder, "envelopes"))
    return rows.select("message_id", "pos", "type", "uuid", "name", "hostname", "poison")


@query(
    "intact_envelopes",
    "SELECT message_id, CASE message_id % 5 WHEN 1 THEN 0 WHEN 2 THEN 2 ELSE 1 END AS n_kept, "
    "CASE message_id % 5 WHEN 3 THEN 2 ELSE 0 END AS n_lost FROM {envelopes}",
)
def intact_envelopes(spark, folder):
    """The whole-envelope form of quarantine, which streams use."""
    return E.envelope_loss(view(spark, folder, "envelopes")).select("message_id", "n_kept", "n_lost")


@query(
    "route_event_types",
    "SELECT event_id, uuid, type, replace(type, 'task-', '') AS kind FROM {raw_task_events} "
    "WHERE type IN ('task-started', 'task-succeeded', 'task-failed', 'task-retried', 'task-revoked')",
)
def route_event_types(spark, folder):
    return E.route_event_types(view(spark, folder, "raw_task_events")).select("event_id", "uuid", "type", "kind")


@query("filter_hostname", "SELECT event_id, uuid, hostname FROM {raw_task_events} WHERE hostname = 'celery@w3'")
def filter_hostname(spark, folder):
    rows = E.filter_hostname(view(spark, folder, "raw_task_events"), "  ", " celery@w3 ")
    return rows.select("event_id", "uuid", "hostname")


@query(
    "quarantine_poison",
    """WITH cuts AS (SELECT message_id AS m, min(pos) AS p FROM {raw_task_events} WHERE poison GROUP BY message_id)
SELECT event_id, message_id, pos, type FROM {raw_task_events} LEFT JOIN cuts ON message_id = m WHERE p IS NULL OR pos < p""",
)
def quarantine_poison(spark, folder):
    kept = E.quarantine_poison(view(spark, folder, "raw_task_events"))
    return kept.select("event_id", "message_id", "pos", "type")


@query("poison_count", "SELECT count(DISTINCT message_id) AS poisoned FROM {raw_task_events} WHERE poison")
def poison_count(spark, folder):
    return E.poison_cuts(view(spark, folder, "raw_task_events")).agg(F.count("*").alias("poisoned"))


@query(
    "absorb_bad_events",
    """SELECT event_id, type, runtime, CASE WHEN type = 'task-succeeded' AND runtime IS NOT NULL AND try_cast(runtime AS double) IS NULL
  THEN 'runtime is not a finite number' END AS rejected FROM {raw_task_events}
WHERE type IN ('task-started', 'task-succeeded', 'task-failed', 'task-retried', 'task-revoked')""",
)
def absorb_bad_events(spark, folder):
    routed = E.route_event_types(view(spark, folder, "raw_task_events"))
    return routed.select("event_id", "type", "runtime", E.rejection().alias("rejected"))


@query(
    "gate_signals",
    """SELECT event_id, signal, state, exception_type FROM {signal_rows} WHERE (signal = 'received' AND has_request)
  OR (signal = 'postrun' AND state = 'SUCCESS') OR (signal = 'failure' AND exception_type IS NOT NULL) OR signal IN ('prerun', 'retry', 'revoked')""",
)
def gate_signals(spark, folder):
    return E.gate_signals(signals(spark, folder)).select("event_id", "signal", "state", "exception_type")


_REQUEST = "coalesce(CASE WHEN has_request THEN request_id END, CASE WHEN has_request THEN request_task_id END, '')"


@query(
    "resolve_signal_task_id",
    f"""SELECT event_id, signal, CASE WHEN signal IN ('received', 'revoked') THEN {_REQUEST}
  WHEN signal = 'retry' THEN coalesce(nullif({_REQUEST}, ''), kwargs_task_id, '') ELSE coalesce(task_id, '') END AS task_id FROM {{signal_rows}}""",
)
def resolve_signal_task_id(spark, folder):
    return signals(spark, folder).select("event_id", "signal", E.signal_task_id().alias("task_id"))


@query(
    "extract_queue",
    "SELECT event_id, CASE WHEN has_request AND has_delivery THEN routing_key END AS queue FROM {signal_rows}",
)
def extract_queue(spark, folder):
    return signals(spark, folder).select("event_id", E.request_queue().alias("queue"))


@query(
    "retain_latest_n",
    "SELECT event_id, event_ts, type FROM {raw_task_events} ORDER BY event_ts DESC, event_id DESC LIMIT 500",
)
def retain_latest_n(spark, folder):
    return E.retain_latest_n(view(spark, folder, "raw_task_events"), 500).select("event_id", "event_ts", "type")


@query(
    "dropped_events",
    f"SELECT greatest(count(*) - {K.EVENT_BUFFER_ROWS // 4}, 0) AS dropped, least(count(*), {K.EVENT_BUFFER_ROWS // 4}) AS kept FROM {{raw_task_events}}",
)
def dropped_events(spark, folder):
    return E.dropped_count(view(spark, folder, "raw_task_events"), K.EVENT_BUFFER_ROWS // 4)
