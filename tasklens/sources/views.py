"""Task telemetry derived from the driver's tables.

One text per view, in the SQL that Spark and DuckDB share; ``{name}`` stands for a table or another view. Spark
fills it with DataFrames, ``with_views`` turns the same text into common table expressions for DuckDB.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasklens.schemas import TABLES
from tasklens.sources.readers import table

_NUMBERED = "FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS int) AS k FROM {events}) e"
_TASK_ID = "concat(CAST(user_id AS varchar(20)), '-', CAST(k % 10 AS varchar(20)))"

_RAW = f"""
SELECT event_id, ts AS event_ts,
       CAST(floor(event_id / 4) AS bigint) AS message_id, CAST(event_id % 4 AS int) AS pos,
       {_TASK_ID} AS uuid,
       CASE event_type WHEN 'signup' THEN 'task-started' WHEN 'click' THEN 'task-retried'
            WHEN 'purchase' THEN 'task-succeeded' WHEN 'error' THEN 'task-failed'
            ELSE CASE WHEN k % 3 = 0 THEN 'task-revoked' ELSE 'task-received' END END AS type,
       CASE WHEN event_type = 'signup' AND k % 4 <> 0
            THEN concat('app.tasks.t', CAST(user_id % 20 AS varchar(20))) END AS name,
       concat('celery@w', CAST(user_id % 5 AS varchar(20))) AS hostname,
       CASE WHEN event_type = 'purchase' THEN CASE WHEN k = 13 THEN 'bad' ELSE
            concat(CAST(CAST(floor(value) AS bigint) AS varchar(20)), '.', lpad(CAST(event_id % 10000 AS varchar(20)), 4, '0')) END END AS runtime,
       CASE WHEN event_type = 'error' AND k % 10 <> 9 THEN CASE k % 3 WHEN 0 THEN 'ValueError(1)'
            WHEN 1 THEN 'app.errors.TaskError(2)' ELSE 'plain failure' END END AS exception,
       k % 50 = 7 AS poison"""

VIEWS = {
    "raw_task_events": f"{_RAW}\n{_NUMBERED}",
    # The same events with the payload fields that only some kinds carry.
    "detailed_events": f"""{_RAW},
       CASE WHEN event_type = 'purchase' AND k % 6 <> 0
            THEN concat('{{{{"ok": ', CAST(k AS varchar(20)), ', "password": "p', CAST(k AS varchar(20)), '"}}}}') END AS result,
       CASE WHEN event_type = 'error' AND k % 7 <> 0
            THEN concat(repeat(concat('frame ', CAST(k AS varchar(20)), '; '), k * 5), 'token=abc', CAST(k AS varchar(20))) END AS traceback,
       CASE k % 4 WHEN 0 THEN true WHEN 1 THEN false END AS terminated,
       CASE WHEN k % 5 = 0 THEN CAST(9 + k % 7 AS int) END AS signum,
       CASE k % 3 WHEN 0 THEN true WHEN 1 THEN false END AS expired
{_NUMBERED}""",
    "signal_rows": f"""
SELECT event_id, ts AS event_ts,
       CASE event_type WHEN 'signup' THEN 'prerun' WHEN 'click' THEN 'retry' WHEN 'purchase' THEN 'postrun'
            WHEN 'error' THEN 'failure' ELSE CASE WHEN k % 3 = 0 THEN 'revoked' ELSE 'received' END END AS signal,
       CASE WHEN k % 23 <> 4 THEN {_TASK_ID} END AS task_id,
       k % 17 <> 5 AS has_request,
       CASE WHEN k % 7 = 1 THEN NULL WHEN k % 7 = 2 THEN '' ELSE {_TASK_ID} END AS request_id,
       CASE WHEN k % 14 <> 1 THEN {_TASK_ID} END AS request_task_id,
       CASE WHEN k % 2 = 0 THEN {_TASK_ID} END AS kwargs_task_id,
       CASE WHEN k % 4 <> 0 THEN concat('app.tasks.t', CAST(user_id % 20 AS varchar(20))) END AS task,
       k % 6 <> 0 AS has_delivery, concat('q', CAST(k % 4 AS varchar(20))) AS routing_key,
       CASE WHEN k % 5 = 0 THEN '' WHEN k % 5 < 3 THEN concat(CAST(user_id AS varchar(20)), '-0') END AS parent_id,
       CASE WHEN k % 5 <> 4 THEN concat(CAST(user_id AS varchar(20)), '-0') END AS root_id,
       CASE WHEN k % 9 = 0 THEN 'FAILURE' WHEN k % 9 <> 5 THEN 'SUCCESS' END AS state,
       CASE WHEN k % 6 <> 0 THEN concat('done ', CAST(k AS varchar(20))) END AS retval,
       CASE WHEN k % 8 <> 0 THEN 'ValueError' END AS exception_type,
       concat('bad value, password: p', CAST(k AS varchar(20))) AS exception_message,
       CASE WHEN k % 3 = 0 THEN concat('einfo ', CAST(k AS varchar(20))) END AS einfo_traceback,
       CASE WHEN k % 4 = 1 THEN concat('trace ', CAST(k AS varchar(20))) END AS traceback,
       CASE WHEN k % 5 = 2 THEN concat('own ', CAST(k AS varchar(20))) END AS exception_traceback,
       CASE WHEN k % 3 = 0 THEN concat('because ', CAST(k AS varchar(20))) END AS reason,
       CASE WHEN k % 3 = 1 THEN concat('einfo ', CAST(k AS varchar(20))) END AS einfo,
       CASE k % 4 WHEN 0 THEN true WHEN 1 THEN false END AS terminated,
       CASE WHEN k % 5 = 0 THEN CAST(9 + k % 7 AS int) END AS signum,
       CASE k % 3 WHEN 0 THEN true WHEN 1 THEN false END AS expired,
       CASE k % 4 WHEN 0 THEN concat('(', CAST(user_id AS varchar(20)), ', ''x'')') WHEN 2 THEN '()'
            WHEN 3 THEN 'no literal(' END AS args,
       CASE k % 3 WHEN 0 THEN concat('{{{{''user_id'': ', CAST(user_id AS varchar(20)), ', ''password'': ''p''}}}}')
            WHEN 1 THEN '{{{{}}}}' END AS kwargs
{_NUMBERED}""",
    # Single events, lists, empty lists and lists with an element that is no event.
    "envelopes": f"""
SELECT event_id AS message_id, event_ts,
       CASE event_id % 5 WHEN 0 THEN first_event WHEN 1 THEN '[]' WHEN 2 THEN concat(' [', first_event, ', ', second_event, ']')
            WHEN 3 THEN concat('[', first_event, ',17,', second_event, ']') ELSE concat('[', second_event, ']') END AS body
FROM (SELECT event_id, ts AS event_ts,
             concat('{{{{"type":"task-', CASE WHEN k % 2 = 0 THEN 'started' ELSE 'failed' END, '","uuid":"', {_TASK_ID}, '","hostname":"w', CAST(k % 3 AS varchar(20)), '"}}}}') AS first_event,
             concat('{{{{"type":"task-sent","uuid":"', {_TASK_ID}, '","name":"t', CAST(k AS varchar(20)), '"}}}}') AS second_event
      {_NUMBERED}) x""",
    # The order in which messages arrive: near their own, never quite; cut into six files.
    "arrivals": """
SELECT d.*, CAST(floor((message_id * 4 + message_id * 7919 % 97) * 6 / (SELECT max(event_id) + 100 FROM {events})) AS int) AS file
FROM {detailed_events} d""",
    "task_meta": """
SELECT concat('app.tasks.t', CAST(p_partkey AS varchar(20))) AS task_name,
       CASE p_size % 5 WHEN 0 THEN 'critical' WHEN 1 THEN 'high' WHEN 2 THEN 'normal' WHEN 3 THEN 'low' END AS priority,
       CAST(p_size * 1000 AS bigint) AS expected_duration_ms, CAST(p_size * 5000 AS bigint) AS deadline_ms,
       lower(p_type) AS tag, p_size % 7 = 0 AS skip, p_size / 50.0 AS sample_rate, p_size % 3 = 0 AS redact_result
FROM {part}""",
    "result_backend": """
SELECT CAST(o_orderkey AS varchar(20)) AS task_id,
       CASE WHEN o_orderkey % 7 <> 0 THEN concat('app.tasks.t', CAST(o_custkey % 20 AS varchar(20))) END AS name,
       CASE WHEN o_orderkey % 5 <> 0 THEN '[1]' END AS args, CASE WHEN o_orderkey % 11 <> 0 THEN '{{}}' END AS kwargs,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'WEIRD'
            WHEN o_orderstatus = 'F' THEN CASE WHEN o_orderpriority = '1-URGENT' THEN 'FAILURE' ELSE 'SUCCESS' END
            WHEN o_orderstatus = 'O' THEN CASE WHEN o_orderpriority = '2-HIGH' THEN 'RETRY' ELSE 'PENDING' END
            ELSE CASE WHEN o_orderpriority = '5-LOW' THEN 'REVOKED' ELSE 'STARTED' END END AS state,
       o_orderdate AS date_done,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'critical' WHEN '2-HIGH' THEN ' High ' WHEN '3-MEDIUM' THEN 'normal'
            WHEN '5-LOW' THEN 'low' ELSE 'bogus' END AS priority_label
FROM {orders}""",
    # The stored results again, under the ids that the events use.
    "stored_states": """
SELECT concat(CAST(CAST(floor(o_orderkey / 10) AS bigint) AS varchar(20)), '-', CAST(o_orderkey % 10 AS varchar(20))) AS task_id, state
FROM (SELECT o.o_orderkey, b.state FROM {orders} o JOIN {result_backend} b ON CAST(o.o_orderkey AS varchar(20)) = b.task_id) x""",
    "retry_requests": """
SELECT o_custkey AS command_id, o_orderkey AS position, CAST(o_orderkey AS varchar(20)) AS task_id,
       o_custkey % 4 * 3 AS max_ids,
       CASE o_orderkey % 6 WHEN 0 THEN '<unknown:late>' WHEN 1 THEN 'unknown' WHEN 2 THEN 'jobs.supplied' WHEN 3 THEN '' END AS supplied_name,
       CASE WHEN o_orderkey % 4 = 0 THEN '[]' END AS override_args,
       CASE WHEN o_orderkey % 4 < 2 THEN '{{"a": 1}}' END AS override_kwargs,
       CASE o_orderkey % 13 WHEN 0 THEN 'soon' WHEN 1 THEN '1703980800' WHEN 2 THEN '1704067140' WHEN 3 THEN '1704067139.5'
            WHEN 4 THEN '1735603200' WHEN 5 THEN '1735603201' WHEN 6 THEN '1e30' WHEN 7 THEN '1704067260' WHEN 8 THEN 'nan' END AS eta,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'critical' WHEN '2-HIGH' THEN ' High ' WHEN '3-MEDIUM' THEN 'normal'
            WHEN '5-LOW' THEN 'low' ELSE 'bogus' END AS priority_label,
       CASE o_orderkey % 5 WHEN 0 THEN 'redis' WHEN 1 THEN 'amqp' WHEN 2 THEN 'sqs' WHEN 3 THEN NULL ELSE 'amqp' END AS transport
FROM {orders}""",
    "tracebacks": "SELECT doc_id, text AS traceback FROM {documents}",
    "lineage": """
SELECT concat(CAST(conv_id AS varchar(20)), ':', CAST(turn AS varchar(20))) AS task_id,
       CASE WHEN turn > 0 THEN concat(CAST(conv_id AS varchar(20)), ':', CAST(turn - 1 AS varchar(20))) END AS parent_task_id,
       concat(CAST(conv_id AS varchar(20)), ':0') AS root_task_id
FROM {conversations}""",
    "command_log": """
SELECT user_id AS batch_id, event_id, ts AS event_ts,
       CASE WHEN event_type IN ('error', 'view') THEN 'indeterminate' WHEN event_type = 'click' THEN 'failed' ELSE 'success' END AS outcome
FROM {events}""",
    "workers": """
SELECT s_name AS hostname, conf_key,
       CASE conf_key WHEN 'task_acks_late' THEN 'false' WHEN 'task_time_limit' THEN NULL ELSE CAST(s_nationkey AS varchar(20)) END AS conf_value
FROM (SELECT *, explode(array('task_acks_late', 'task_time_limit', 'worker_concurrency', 'broker_url', 'result_backend')) AS conf_key
      FROM {supplier}) s""",
    "pools": """
SELECT s_name AS hostname, s_suppkey % 9 <> 0 AS has_controller,
       CASE s_suppkey % 4 WHEN 0 THEN 'app.concurrency.prefork' WHEN 1 THEN 'prefork' WHEN 2 THEN 'solo' END AS pool,
       CASE s_suppkey % 3 WHEN 0 THEN 200 WHEN 1 THEN 0 END AS max_tasks_per_child,
       CASE WHEN s_suppkey % 5 = 0 THEN 150000 END AS max_memory_per_child,
       CASE WHEN s_suppkey % 2 = 0 THEN 100 END AS worker_max_tasks_per_child,
       CASE WHEN s_suppkey % 7 < 4 THEN 250000 WHEN s_suppkey % 7 = 4 THEN 0 END AS worker_max_memory_per_child
FROM {supplier}""",
    "pending_messages": "SELECT l_orderkey, l_linenumber, concat('q', CAST(l_suppkey % 8 AS varchar(20))) AS queue FROM {lineitem} WHERE l_linestatus = 'O'",
    "queue_conf": """
SELECT s_suppkey AS app, CASE s_suppkey % 4 WHEN 0 THEN concat('q', CAST(s_suppkey % 10 AS varchar(20)), ',q', CAST(s_suppkey % 10 + 1 AS varchar(20))) WHEN 1 THEN '' END AS queue_list,
       CASE WHEN s_suppkey % 3 <> 0 THEN concat('q', CAST(s_suppkey % 9 AS varchar(20))) END AS task_default_queue
FROM {supplier}""",
    "purge_requests": """
SELECT s_suppkey AS request_id, concat('q', CAST(s_suppkey % 12 AS varchar(20))) AS queue, s_suppkey % 10 = 0 AS force,
       CASE WHEN s_suppkey % 7 <> 1 THEN concat('t', CAST(s_suppkey % 2 AS varchar(20))) END AS confirm_token,
       concat('t', CAST(s_nationkey % 2 AS varchar(20))) AS expected_token
FROM {supplier}""",
    "registry": """
SELECT concat(CASE WHEN p_partkey % 11 = 0 THEN 'celery.' ELSE 'app.' END, replace(p_name, ' ', '_'), '.', CAST(p_partkey % 100 AS varchar(20))) AS name,
       p_partkey AS seq, p_partkey % 3 <> 0 AS loaded, CASE WHEN p_size % 4 = 0 THEN '' ELSE lower(p_brand) END AS queue
FROM {part}""",
    # Two snapshots of one registry: some names leave, some arrive, some change their queue.
    "registry_before": "SELECT name, max(queue) AS queue FROM {registry} WHERE seq % 5 <> 0 GROUP BY name",
    "registry_after": "SELECT name, max(CASE WHEN seq % 4 = 1 THEN 'moved' ELSE queue END) AS queue FROM {registry} WHERE seq % 5 <> 1 GROUP BY name",
    "submissions": "SELECT o_orderkey AS submission_id, concat('app.tasks.t', CAST(o_custkey % 40 AS varchar(20))) AS name FROM {orders}",
    "broker_urls": """
SELECT page_id, concat(CASE page_id % 5 WHEN 0 THEN 'REDIS://' WHEN 1 THEN 'amqp://' WHEN 2 THEN 'sqs://' WHEN 3 THEN 'pyamqp+rabbit://' ELSE 'memory://' END,
              regexp_extract(url, 'https?://([^/?#]*)', 1)) AS url,
       CASE page_id % 7 WHEN 0 THEN ' Redis+Sentinel ' WHEN 1 THEN 'PYAMQP' WHEN 2 THEN 'librabbitmq' WHEN 3 THEN '' WHEN 4 THEN 'sqs' WHEN 5 THEN 'amqps' END AS driver,
       CASE page_id % 6 WHEN 0 THEN 'Prefork' WHEN 1 THEN 'app.concurrency.Solo:TaskPool' WHEN 2 THEN 'gevent' WHEN 3 THEN 'EVENTLET' WHEN 4 THEN '' END AS pool
FROM {pages}""",
    "rate_requests": """
SELECT p_partkey AS request_id, CASE WHEN p_partkey % 6 = 0 THEN '' WHEN p_partkey % 6 <> 1 THEN p_name END AS task_name,
       CASE p_partkey % 11 WHEN 0 THEN '0' WHEN 1 THEN CAST(p_size AS varchar(20)) WHEN 2 THEN concat(CAST(p_size AS varchar(20)), '/s')
            WHEN 3 THEN concat(CAST(p_size AS varchar(20)), '/m') WHEN 4 THEN concat(CAST(p_size AS varchar(20)), '/h') WHEN 5 THEN '0/s'
            WHEN 6 THEN '' WHEN 7 THEN concat(CAST(p_size AS varchar(20)), '/d') WHEN 8 THEN concat('0', CAST(p_size AS varchar(20))) WHEN 9 THEN '-1' END AS rate
FROM {part}""",
    # Source trees with one app per part; packages end where an __init__.py is missing.
    "source_files": """
SELECT p_partkey, p_size, p_name, p_brand, file, concat('/src/', CASE WHEN p_partkey % 3 = 0 THEN 'lib/' ELSE '' END, 'app', CAST(p_partkey AS varchar(20)), '/', file) AS path,
       CASE WHEN p_partkey % 17 = 3 AND file = 'tasks.py' THEN CAST(2097153 AS bigint) ELSE CAST(100 + p_size AS bigint) END AS length
FROM (SELECT *, explode(array('tasks.py', 'models.py', 'celery.py', '__init__.py', 'tasks/__init__.py', 'tasks/mail.py', 'tasks/_private.py',
                              'tasks/deep/more.py')) AS file FROM {part}) f
WHERE NOT (file = '__init__.py' AND p_partkey % 4 = 1)""",
    "meta_rows": """
SELECT p_partkey AS row_id, CAST(p_size - 10 AS double) / 32 AS sample_rate,
       CASE p_partkey % 6 WHEN 0 THEN 'critical' WHEN 1 THEN 'high' WHEN 2 THEN 'urgent' WHEN 3 THEN 'low' WHEN 4 THEN '' END AS priority
FROM {part}""",
    "name_cases": f"""
SELECT event_id, CASE k % 6 WHEN 0 THEN '' WHEN 1 THEN concat('app.t', CAST(k AS varchar(20))) WHEN 2 THEN 'unknown' WHEN 3 THEN concat('<unknown:q', CAST(k AS varchar(20)), '>') END AS name,
       CASE k % 5 WHEN 0 THEN '' WHEN 1 THEN '  ' WHEN 2 THEN concat(' hint', CAST(k AS varchar(20)), ' ') END AS hint,
       CASE k % 4 WHEN 0 THEN '' WHEN 1 THEN concat('q', CAST(k AS varchar(20))) END AS queue,
       CASE k % 7 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE concat(CAST(event_id AS varchar(20)), '-abcdefgh') END AS task_id
{_NUMBERED}""",
    "payload_cases": f"""
SELECT event_id, user_id, k, event_type,
       CASE k % 9 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN concat('(', CAST(k AS varchar(20)), ', ''', event_type, ''')') WHEN 3 THEN concat('[', CAST(k AS varchar(20)), ', None, True]')
            WHEN 4 THEN '(1,' WHEN 5 THEN concat('{{{{''k'': ', CAST(k AS varchar(20)), '}}}}') WHEN 6 THEN '()' WHEN 7 THEN concat('(', CAST(k AS varchar(20)), ',)') ELSE 'open(''x'')' END AS args,
       CASE k % 8 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '{{{{}}}}' WHEN 3 THEN concat('{{{{''user_id'': ', CAST(user_id AS varchar(20)), ', ''kind'': ''', event_type, '''}}}}')
            WHEN 4 THEN '{{{{''k'':' WHEN 5 THEN '[1]' WHEN 6 THEN '__import__(''os'')' ELSE concat('{{{{''n'': [', CAST(k AS varchar(20)), ']}}}}') END AS kwargs
{_NUMBERED}""",
}


def _names(text: str) -> list[str]:
    return re.findall(r"(?<!\{)\{(\w+)\}(?!\})", text)


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A view over the tables in ``folder``."""
    if name in TABLES:
        return table(spark, folder, name)
    text = VIEWS[name]
    return spark.sql(text, **{n: view(spark, folder, n) for n in _names(text)})


def with_views(text: str) -> str:
    """``text`` as one DuckDB statement: the views it names as ``{name}`` become common table expressions."""
    order: list[str] = []

    def add(body: str) -> None:
        for n in _names(body):
            if n in VIEWS and n not in order:
                add(VIEWS[n])
                order.append(n)

    add(text)
    bodies = {n: _plain(VIEWS[n]) for n in order}
    text = _plain(text.strip())
    if text.upper().startswith("WITH "):
        ctes, text = text[5:], ""
        parts = [f"{n} AS ({b})" for n, b in bodies.items()] + [ctes]
    else:
        parts = [f"{n} AS ({b})" for n, b in bodies.items()]
    return ("WITH RECURSIVE " + ",\n".join(parts) + "\n" + text) if parts else text


def _plain(text: str) -> str:
    """Without the braces around names, with doubled braces single, and with DuckDB's name for opening a list."""
    text = text.replace("explode(array(", "unnest(list_value(")
    text = re.sub(r"(?<!\{)\{(\w+)\}(?!\})", r"\1", text)
    return text.replace("{{", "{").replace("}}", "}")


def signals(spark: SparkSession, folder: str) -> DataFrame:
    """``signal_rows`` with the request as the nested value that producers send."""
    rows = view(spark, folder, "signal_rows")
    delivery = F.when(F.col("has_delivery"), F.create_map(F.lit("routing_key"), F.col("routing_key")))
    request = F.struct(
        F.col("request_id").alias("id"),
        F.col("request_task_id").alias("task_id"),
        "task",
        "args",
        "kwargs",
        delivery.alias("delivery_info"),
        "parent_id",
        "root_id",
    )
    flat = ("has_request", "request_id", "request_task_id", "has_delivery", "routing_key", "parent_id", "root_id")
    return rows.withColumn("request", F.when(F.col("has_request"), request)).drop(*flat)


def metadata(spark: SparkSession, folder: str) -> DataFrame:
    """``task_meta`` with its tag as the list that metadata carries."""
    meta = view(spark, folder, "task_meta")
    return meta.withColumns(
        {"tags": F.array("tag"), "sample_rate": F.col("sample_rate").cast("double")}
    ).drop("tag")
