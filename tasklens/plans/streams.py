"""Streaming queries: each runs over the whole table with the trigger that stops when all input is read."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tasklens.operators.envelope import route_event_types
from tasklens.plans.catalog import SIGNALS_SQL, canonical, canonical_signals, cut, joined, named_sql, query, scrubbed
from tasklens.schemas import ENVELOPE, RAW_EVENT
from tasklens.session import new_folder, stored
from tasklens.sources.readers import stream_task_events, with_instant
from tasklens.sources.views import metadata, view
from tasklens.streaming import runs as S
from tasklens.streaming.late import counted_sessions, counted_windows
from tasklens.streaming.lifecycle import arriving_events, start_lifecycle
from tasklens.streaming.ordered import named_in_order
from tasklens.streaming.pairing import pair_captures


def _raw(spark, folder):
    return S.stream_view(spark, folder, "raw_task_events")


_FIELDS = ("type", "uuid", "name", "hostname", "runtime", "exception", "result", "traceback", "terminated", "signum", "expired")


def _append_in_order(rows, purpose, file_rows, numbers=None, clock=None):
    """``rows`` as files in the order of their numbers ``file``: the folder, and how many files a batch has.

    Each number (of ``numbers``, if given) is as many files as the largest needs, so that many tasks read a batch and it still
    ends where its number does. ``clock`` rows come last. The source takes files in the order of their times.
    """
    spark, schema = rows.sparkSession, rows.drop("file").schema
    parts, path = new_folder(spark, f"{purpose}-parts"), new_folder(spark, purpose)
    rows.filter(F.col("file").isNotNull()).write.partitionBy("file").parquet(parts)
    held = spark.read.schema(rows.schema).parquet(parts)
    counts = {r["file"]: r["count"] for r in held.groupBy("file").count().collect()}
    each = max([1, *[-(-n // file_rows) for n in counts.values()]])
    for number in sorted(counts) if numbers is None else numbers:
        own = held.filter(F.col("file") == number).drop("file")
        # Where some of the files could come out empty, and so not at all, all rows are in one.
        spread = counts.get(number, 0) >= 100 * each
        (own.repartition(each) if spread else own.coalesce(1)).write.mode("append").parquet(path)
        for _ in range(0 if spread else each - 1):
            spark.createDataFrame([], schema).coalesce(1).write.mode("append").parquet(path)
    if clock is not None:
        spark.createDataFrame(clock, schema).coalesce(1).write.mode("append").parquet(path)
    return path, each


def write_envelopes(spark, folder, plain=False):
    """The raw events as envelopes in arrival order, a number of files per batch to come; some are delivered again a batch later.

    Poisoned elements are what is no event. The last file has a clock row far ahead, so that nothing waits for more.
    ``plain`` leaves out what is delivered again, and the clock. Returns the folder and the number of files in a batch.
    """
    rows = view(spark, folder, "arrivals")
    seconds = (F.unix_micros(F.col("event_ts").cast("timestamp")) / 1_000_000).alias("timestamp")
    body = F.when(F.col("poison"), F.lit("17")).otherwise(F.to_json(F.struct(*_FIELDS, seconds)))
    messages = rows.groupBy("message_id", "file").agg(
        F.max("event_ts").alias("ingest_ts"), F.array_sort(F.collect_list(F.struct("pos", body.alias("body")))).alias("items")
    )
    messages = messages.withColumn("body", F.concat(F.lit("["), F.array_join("items.body", ","), F.lit("]"))).drop("items")
    if plain:
        return _append_in_order(messages, "envelopes", 20_000)
    files = F.when(F.expr("message_id % 7 = 3"), F.array("file", F.col("file") + 1)).otherwise(F.array("file"))
    clock = [(-1, None, '{"type": "clock", "timestamp": 4102444800}')]
    # In the order of ENVELOPE, which the clock rows have.
    sent = messages.select("message_id", "ingest_ts", "body", F.explode(files).alias("file"))
    return _append_in_order(sent, "envelopes", 20_000, clock=clock)


def _envelopes(spark, folder, plain=False):
    path, files = write_envelopes(spark, folder, plain)
    return stream_task_events(spark, path, schema=ENVELOPE, maxFilesPerTrigger=files)


def _naive(*names):
    """Instants back to plain times, as the tables have them."""
    return {n: F.col(n).cast("timestamp_ntz") for n in names}


@query(
    "stream_normalise",
    """WITH firsts AS (SELECT message_id, CASE WHEN message_id % 5 = 0 THEN json(body) ELSE json_extract(json(ltrim(body)), '$[0]') END AS item
  FROM {envelopes} WHERE message_id % 5 IN (0, 2, 3))
SELECT 'broker:' || message_id || '.0' AS event_id, item->>'$.uuid' AS task_id, replace(item->>'$.type', 'task-', '') AS kind,
  item->>'$.hostname' AS worker, '<unknown:' || left(item->>'$.uuid', 8) || '>' AS task_name,
  CASE WHEN item->>'$.type' = 'task-failed' THEN 'Unknown error' END AS exception_message FROM firsts""",
)
def stream_normalise(spark, folder):
    events = S.append_all(S.normalised(S.stream_view(spark, folder, "envelopes")), "normalised")
    return events.select("event_id", "task_id", "kind", "worker", "task_name", "exception_message")


# Wider than any message or its way is long.
_DELAY = "5 days"


@query(
    "stream_carry_name",
    f"WITH {named_sql('detailed_events')} SELECT message_id || '.' || pos AS event_id, uuid, kind, event_ts, name, carried_name FROM named",
)
def stream_carry_name(spark, folder):
    """Names out of six files of disordered envelopes: what the batch gives in order."""
    named = named_in_order(arriving_events(_envelopes(spark, folder)), _DELAY, "1 day", None, order=("message_id", "pos"))
    with S.settings(spark, S.stateful(spark)):
        rows = S.append_all(named, "ordered-names").dropDuplicates(["event_id"])
    return rows.withColumns(_naive("event_ts")).select("event_id", "uuid", "kind", "event_ts", "name", "carried_name")


@query(
    "stream_lifecycle",
    rf"""WITH {named_sql('detailed_events')}, sent AS (SELECT message_id AS m, max(event_ts) AS ingest_ts FROM {{raw_task_events}} GROUP BY message_id)
SELECT 'broker:' || message_id || '.' || pos AS event_id, uuid AS task_id, kind, event_ts, ingest_ts, n.task_name, hostname AS worker,
  m.tag AS tags, m.priority, m.expected_duration_ms, m.deadline_ms,
  CASE WHEN kind = 'succeeded' THEN CASE WHEN m.redact_result THEN '[REDACTED]' ELSE {scrubbed('result')} END END AS result, runtime_ms,
  CASE WHEN kind = 'failed' THEN CASE WHEN regexp_matches(exception, '^[A-Za-z_]\w*(\.[A-Za-z_]\w*)*\(')
    THEN regexp_extract(exception, '^(?:[A-Za-z_]\w*\.)*([A-Za-z_]\w*)\(', 1) ELSE 'Exception' END END AS exception,
  CASE WHEN kind = 'failed' THEN coalesce(exception, 'Unknown error') END AS exception_message,
  CASE WHEN kind = 'failed' THEN {scrubbed(cut('traceback', 4096))} END AS traceback, CASE WHEN kind = 'retried' THEN exception END AS reason,
  CASE WHEN kind = 'revoked' THEN coalesce(terminated, false) END AS terminated, CASE WHEN kind = 'revoked' THEN signum END AS signum,
  CASE WHEN kind = 'revoked' THEN coalesce(expired, false) END AS expired
FROM named n JOIN sent ON message_id = sent.m LEFT JOIN {{task_meta}} m ON n.task_name = m.task_name""",
)
def stream_lifecycle(spark, folder):
    """The whole way from disordered envelopes to stored events, some delivered twice, batch by batch."""
    path = new_folder(spark, "lifecycle")
    envelopes, meta = _envelopes(spark, folder), metadata(spark, folder)
    with S.settings(spark, S.stateful(spark)):
        run = start_lifecycle(envelopes, f"{path}/events", f"{path}/checkpoint", meta, delay=_DELAY, slot="1 day", remember=None)
    run.awaitTermination()
    events = spark.read.parquet(f"{path}/events")
    return events.withColumn("tags", joined(F.col("tags"))).select(
        "event_id", "task_id", "kind", "event_ts", "ingest_ts", "task_name", "worker", "tags", "priority", "expected_duration_ms",
        "deadline_ms", "result", "runtime_ms", "exception", "exception_message", "traceback", "reason", "terminated", "signum", "expired",
    )


@query("stream_dedupe", "SELECT event_id, type FROM {raw_task_events}")
def stream_dedupe(spark, folder):
    rows = with_instant(_raw(spark, folder)).select("event_id", "event_ts", "type")
    resent = rows.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.pmod("event_id", F.lit(3)).cast("int"))))
    return S.append_all(S.deduped(resent.drop("_copy")), "deduped").select("event_id", "type")


@query(
    "stream_counts",
    "SELECT date_trunc('hour', event_ts) AS window_start, hostname, type, count(*) AS n FROM {raw_task_events} GROUP BY 1, 2, 3",
)
def stream_counts(spark, folder):
    totals = S.window_totals(with_instant(_raw(spark, folder)), ("hostname", "type"), "1 hour")
    return totals.withColumns(_naive("window_start"))


@query(
    "stream_sliding_counts",
    """SELECT s AS window_start, type, count(*) AS n FROM (SELECT type, unnest([time_bucket(INTERVAL 30 MINUTE, event_ts),
  time_bucket(INTERVAL 30 MINUTE, event_ts) - INTERVAL 30 MINUTE]) AS s FROM {raw_task_events}) x GROUP BY 1, 2""",
)
def stream_sliding_counts(spark, folder):
    totals = S.window_totals(with_instant(_raw(spark, folder)), ("type",), "1 hour", "30 minutes")
    return totals.withColumns(_naive("window_start"))


# What a file's rows may be late for: the newest time of the files before it, less the delay.
_MARKS = """highs AS (SELECT file, max(event_ts) AS high FROM {arrivals} GROUP BY file),
marks AS (SELECT file, max(high) OVER (ORDER BY file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 5 MINUTE AS watermark FROM highs),
final AS (SELECT max(high) - INTERVAL 5 MINUTE AS last FROM highs)"""
_LATE_WINDOWS = "coalesce(time_bucket(INTERVAL 10 MINUTE, event_ts) + INTERVAL 10 MINUTE <= watermark, false)"


def _arrivals(spark, folder):
    """The raw events in files, in the order in which they arrive."""
    rows = view(spark, folder, "arrivals")
    path = new_folder(spark, "arrivals")
    for (i,) in rows.select("file").distinct().orderBy("file").collect():
        rows.filter(F.col("file") == i).drop("file").coalesce(1).write.mode("append").parquet(path)
    return with_instant(stream_task_events(spark, path, schema=RAW_EVENT, maxFilesPerTrigger=1))


@query(
    "stream_windows_in_time",
    f"""WITH {_MARKS}
SELECT time_bucket(INTERVAL 10 MINUTE, event_ts) AS window_start, hostname, type, count(*) AS n,
  time_bucket(INTERVAL 10 MINUTE, event_ts) + INTERVAL 10 MINUTE <= (SELECT last FROM final) AS closed
FROM {{arrivals}} JOIN marks USING (file) WHERE NOT {_LATE_WINDOWS} GROUP BY 1, 2, 3""",
)
def stream_windows_in_time(spark, folder):
    counted = counted_windows(_arrivals(spark, folder), ("hostname", "type"), "10 minutes", "5 minutes")
    return counted.counts.withColumns(_naive("window_start"))


@query(
    "stream_late_rows",
    f"""WITH {_MARKS}
SELECT event_id, event_ts, type, file AS batch_id, watermark FROM {{arrivals}} JOIN marks USING (file) WHERE {_LATE_WINDOWS}""",
)
def stream_late_rows(spark, folder):
    """The rows that the counts leave out, each with the watermark that it missed."""
    counted = counted_windows(_arrivals(spark, folder), ("hostname", "type"), "10 minutes", "5 minutes")
    return counted.late.withColumns(_naive("event_ts", "watermark")).select("event_id", "event_ts", "type", "batch_id", "watermark")


@query(
    "stream_session_counts",
    f"""WITH {_MARKS},
fresh AS (SELECT * FROM {{arrivals}} JOIN marks USING (file) WHERE NOT coalesce(event_ts + INTERVAL 20 MINUTE <= watermark, false)),
marked AS (SELECT hostname, event_ts, CASE WHEN event_ts > lag(event_ts) OVER (PARTITION BY hostname ORDER BY event_ts) + INTERVAL 20 MINUTE THEN 1 ELSE 0 END AS cut FROM fresh),
numbered AS (SELECT *, sum(cut) OVER (PARTITION BY hostname ORDER BY event_ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session FROM marked)
SELECT hostname, min(event_ts) AS session_start, max(event_ts) + INTERVAL 20 MINUTE AS session_end, count(*) AS n,
  max(event_ts) + INTERVAL 20 MINUTE <= (SELECT last FROM final) AS closed FROM numbered GROUP BY hostname, session""",
)
def stream_session_counts(spark, folder):
    """All sessions of rows in time, those still open at the end among them."""
    counted = counted_sessions(_arrivals(spark, folder), ("hostname",), "20 minutes", "5 minutes")
    return counted.counts.withColumns(_naive("session_start", "session_end"))


def _capture_stream(spark, events, name):
    """Canonical events as a stream of six files in the order of their times, closed by a clock row."""
    slim = events.select("event_id", "task_id", "kind", "event_ts", "capture")
    number = F.coalesce(F.regexp_extract("event_id", "([0-9]+)", 1).cast("long"), F.lit(0))
    rows = stored(slim.withColumn("_n", number), "captures")
    last = rows.agg(F.max("_n")).first()[0] + 100
    # Arrival is out of order within about a hundred events.
    placed = rows.withColumn("file", F.floor((F.col("_n") + F.col("_n") * 7919 % 97) * 6 / last).cast("int")).drop("_n")
    clock = [(f"clock {name}", "", "clock", datetime(2100, 1, 1), name)]
    path, files = _append_in_order(placed, "capture-files", 100_000, range(6), clock)
    return with_instant(stream_task_events(spark, path, schema=slim.schema, maxFilesPerTrigger=files))


@query(
    "stream_pair_captures",
    f"""WITH {named_sql()}, {SIGNALS_SQL},
b AS (SELECT 'broker:' || event_id AS event_id, uuid AS task_id, kind, event_ts, 'broker' AS capture FROM named),
s AS (SELECT 'signal:' || event_id AS event_id, tid AS task_id, kind, event_ts, 'signal' AS capture FROM sig),
pairs AS (SELECT b.event_id AS broker_id, s.event_id AS signal_id, coalesce(b.kind, s.kind) AS kind,
    s.event_id IS NOT NULL AND (coalesce(b.kind, s.kind) = 'received' OR b.event_id IS NULL) AS signal_first,
    b.task_id AS bt, s.task_id AS st, b.event_ts AS be, s.event_ts AS se
  FROM b FULL JOIN s ON b.task_id = s.task_id AND b.task_id <> '' AND b.kind = s.kind
    AND s.event_ts BETWEEN b.event_ts - INTERVAL 5 SECOND AND b.event_ts + INTERVAL 5 SECOND)
SELECT CASE WHEN signal_first THEN signal_id ELSE broker_id END AS event_id, CASE WHEN signal_first THEN st ELSE bt END AS task_id, kind,
  CASE WHEN signal_first THEN se ELSE be END AS event_ts, CASE WHEN signal_first THEN 'signal' ELSE 'broker' END AS capture, broker_id, signal_id FROM pairs""",
)
def stream_pair_captures(spark, folder):
    """Copies of one transition on both paths meet in a stream-stream join; what has no partner comes out alone."""
    broker = _capture_stream(spark, canonical(spark, folder), "broker")
    signal = _capture_stream(spark, canonical_signals(spark, folder), "signal")
    with S.settings(spark, S.stateful(spark)):
        return S.append_all(pair_captures(broker, signal, "5 seconds", _DELAY), "pairs").withColumns(_naive("event_ts"))


@query(
    "stream_latest_state",
    """SELECT uuid AS task_id, arg_max(replace(type, 'task-', ''), (event_ts, event_id)) AS kind, min(event_ts) AS first_ts, max(event_ts) AS last_ts, count(*) AS n_events
FROM {raw_task_events} WHERE type IN ('task-started', 'task-succeeded', 'task-failed', 'task-retried', 'task-revoked') GROUP BY uuid""",
)
def stream_latest_state(spark, folder):
    return S.latest_state(route_event_types(_raw(spark, folder)).withColumnRenamed("uuid", "task_id"))


@query(
    "stream_loss_metrics",
    """WITH cuts AS (SELECT message_id AS m, min(pos) AS p FROM {raw_task_events} WHERE poison GROUP BY message_id),
placed AS (SELECT *, b.p IS NULL OR r.pos < b.p AS kept, type IN ('task-started', 'task-succeeded', 'task-failed', 'task-retried', 'task-revoked') AS routed
  FROM {raw_task_events} r LEFT JOIN cuts b ON r.message_id = b.m)
SELECT count(DISTINCT message_id) AS envelopes, (SELECT count(*) FROM cuts) AS poisoned, count(*) FILTER (NOT kept) AS lost,
  count(*) FILTER (kept AND NOT routed) AS unrouted, count(*) FILTER (kept AND routed) AS written FROM placed""",
)
def stream_loss_metrics(spark, folder):
    """What the progress of a stream of several batches tells as lost, beside what it stored."""
    path = new_folder(spark, "routed")
    losses = S.loss_metrics(_envelopes(spark, folder, plain=True), path)
    written = spark.read.parquet(path).agg(F.count("*").alias("written"))
    return losses.agg(*[F.sum(c).alias(c) for c in S.LOSSES]).join(written)


@query(
    "stream_registry_delta",
    """SELECT 0 AS snapshot_id, name, 'added' AS change, queue FROM {registry_before}
UNION ALL SELECT 1, coalesce(a.name, b.name), CASE WHEN b.name IS NULL THEN 'added' WHEN a.name IS NULL THEN 'removed' ELSE 'updated' END, a.queue
FROM {registry_after} a FULL JOIN {registry_before} b ON a.name = b.name
WHERE a.name IS NULL OR b.name IS NULL OR a.queue IS DISTINCT FROM b.queue""",
)
def stream_registry_delta(spark, folder):
    path = new_folder(spark, "registry-snapshots")
    rows, previous = [], None
    for i, name in enumerate(("registry_before", "registry_after")):
        snapshot = f"{path}/{name}"
        view(spark, folder, name).write.parquet(snapshot)
        rows.append((i, snapshot, previous))
        previous = snapshot
    spark.createDataFrame(rows, S.MANIFEST).write.parquet(f"{path}/manifests")
    manifests = stream_task_events(spark, f"{path}/manifests", schema=S.MANIFEST)
    return S.registry_changes(manifests, ("queue",)).select("snapshot_id", "name", "change", "queue")
