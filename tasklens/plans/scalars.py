"""Column functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tasklens.functions import control as C
from tasklens.functions import payload as P
from tasklens.functions import text as T
from tasklens.functions.nested import scrub_nested as scrub_hidden
from tasklens.plans.catalog import cut, query, scrubbed, shown
from tasklens.sources.views import metadata, signals, view

# The instant that ETAs are judged against: 2024-01-01 00:00:00 UTC.
NOW = 1_704_067_200


@query(
    "coerce_args",
    """SELECT event_id, CASE k % 9 WHEN 2 THEN '[' || k || ', "' || event_type || '"]' WHEN 3 THEN '[' || k || ', null, true]'
  WHEN 6 THEN '[]' WHEN 7 THEN '[' || k || ']' END AS args FROM {payload_cases}""",
)
def coerce_args(spark, folder):
    return view(spark, folder, "payload_cases").select("event_id", P.coerce_args(F.col("args")).alias("args"))


@query(
    "coerce_kwargs",
    """SELECT event_id, CASE k % 8 WHEN 2 THEN '' WHEN 3 THEN 'kind=' || event_type || ';user_id=' || user_id
  WHEN 7 THEN 'n=[' || k || ']' END AS kwargs FROM {payload_cases}""",
)
def coerce_kwargs(spark, folder):
    return view(spark, folder, "payload_cases").select(
        "event_id", shown(P.coerce_kwargs(F.col("kwargs"))).alias("kwargs")
    )


def _listed(k, *choices):
    """A list column that varies with k; None stands for no list."""
    out = None
    for i, names in enumerate(choices):
        value = F.lit(None).cast("array<string>") if names is None else F.array(*map(F.lit, names)).cast("array<string>")
        out = F.when(k % len(choices) == i, value) if out is None else out.when(k % len(choices) == i, value)
    return out


@query(
    "scrub_kwargs",
    f"""WITH pairs AS (
  SELECT event_id, k, 'user_id' AS key, CAST(user_id AS varchar) AS value FROM {{payload_cases}}
  UNION ALL SELECT event_id, k, 'Password', 'p' || k FROM {{payload_cases}}
  UNION ALL SELECT event_id, k, 'custom_field', event_type FROM {{payload_cases}}
  UNION ALL SELECT event_id, k, 'note', 'token=abc' || k FROM {{payload_cases}}),
kept AS (SELECT event_id, key, CASE WHEN key = 'Password' OR (key = 'custom_field' AND k % 2 = 0) THEN '[REDACTED]' ELSE {scrubbed("value")} END AS value
  FROM pairs WHERE k % 4 = 0 OR (k % 4 = 1 AND key IN ('user_id', 'Password')) OR (k % 4 = 3 AND key IN ('custom_field', 'note')))
SELECT c.event_id, coalesce(string_agg(key || '=' || value, ';' ORDER BY key), '') AS kwargs
FROM {{payload_cases}} c LEFT JOIN kept ON c.event_id = kept.event_id GROUP BY c.event_id""",
)
def scrub_kwargs(spark, folder):
    k = F.col("k")
    given = F.create_map(
        F.lit("user_id"), F.col("user_id").cast("string"),
        F.lit("Password"), F.concat(F.lit("p"), k),
        F.lit("custom_field"), F.col("event_type"),
        F.lit("note"), F.concat(F.lit("token=abc"), k),
    )
    keep = _listed(k, None, ("user_id", "Password"), (), ("custom_field", "note"))
    redact = _listed(k, ("custom_field",), ())
    rows = view(spark, folder, "payload_cases")
    return rows.select("event_id", shown(P.scrub_kwargs(given, redact, keep)).alias("kwargs"))


@query(
    "scrub_args",
    f"""SELECT event_id, CASE WHEN args IS NULL THEN NULL WHEN k % 3 <> 0 THEN '[REDACTED]' ELSE {scrubbed("args || ' secret: ' || k")} END AS args
FROM {{payload_cases}}""",
)
def scrub_args(spark, folder):
    keep = _listed(F.col("k"), None, (), ("user_id",))
    given = F.concat(F.col("args"), F.lit(" secret: "), F.col("k"))
    return view(spark, folder, "payload_cases").select("event_id", P.scrub_args(given, keep).alias("args"))


@query(
    "scrub_result",
    f"""SELECT e.event_id, CASE WHEN m.redact_result THEN '[REDACTED]' ELSE {scrubbed("e.retval || ' api_key=' || e.event_id")} END AS result
FROM {{signal_rows}} e LEFT JOIN {{task_meta}} m ON e.task = m.task_name""",
)
def scrub_result(spark, folder):
    meta = metadata(spark, folder).select("task_name", "redact_result")
    rows = signals(spark, folder).join(meta, F.col("task") == F.col("task_name"), "left")
    given = F.concat("retval", F.lit(" api_key="), "event_id")
    return rows.select("event_id", P.scrub_result(given, F.col("redact_result")).alias("result"))


_NESTED = """concat('{{"who": "', event_type, '", "rest": [1, {{"deep": {{"Token": "x, y ', CAST(k AS varchar(20)), '", "n": ', CAST(k AS varchar(20)),
  ', "more": [{{"credit_card": 4111}}]}}}}], "ssn": [', CAST(k AS varchar(20)), ', 2], "note": "password=a,b c", "none": null}}')"""


@query(
    "scrub_nested",
    f"""WITH docs AS (SELECT event_id, k, json({_NESTED}) AS doc FROM {{payload_cases}})
SELECT event_id, doc->>'$.who' AS who, '[REDACTED]' AS token, doc->>'$.rest[1].deep.n' AS n, '[REDACTED]' AS card, '[REDACTED]' AS ssn,
  'password=[REDACTED]' AS note, json_type(doc, '$.none') = 'NULL' AS none_kept, len(json_keys(doc)) AS n_keys FROM docs""",
)
def scrub_nested(spark, folder):
    """Sensitive keys at three levels, with values that hold blanks, commas, numbers and lists."""
    rows = view(spark, folder, "payload_cases")
    given = F.expr(_NESTED.replace("{{", "{").replace("}}", "}").replace("varchar(20)", "string"))
    out = rows.select("event_id", scrub_hidden(given).alias("doc"))

    def at(path):
        return F.get_json_object("doc", path)

    return out.select(
        "event_id", at("$.who").alias("who"), at("$.rest[1].deep.Token").alias("token"), at("$.rest[1].deep.n").alias("n"),
        at("$.rest[1].deep.more[0].credit_card").alias("card"), at("$.ssn").alias("ssn"), at("$.note").alias("note"),
        F.col("doc").contains('"none":null').alias("none_kept"), F.size(F.json_object_keys("doc")).alias("n_keys"),
    )


@query("scrub_text", f"SELECT doc_id, {scrubbed('traceback')} AS text FROM {{tracebacks}}")
def scrub_text(spark, folder):
    return view(spark, folder, "tracebacks").select("doc_id", T.scrub_text(F.col("traceback")).alias("text"))


@query(
    "runtime_ms",
    "SELECT event_id, runtime, CAST(trunc(try_cast(runtime AS double) * 1000) AS bigint) AS runtime_ms FROM {raw_task_events}",
)
def runtime_ms(spark, folder):
    return view(spark, folder, "raw_task_events").select(
        "event_id", "runtime", P.runtime_ms(F.col("runtime")).alias("runtime_ms")
    )


@query(
    "exception_class",
    r"""SELECT event_id, coalesce(nullif(exception, ''), 'Unknown error') AS message,
  CASE WHEN regexp_matches(left(exception, 256), '^[A-Za-z_]\w*(\.[A-Za-z_]\w*)*\(')
    THEN regexp_extract(left(exception, 256), '^(?:[A-Za-z_]\w*\.)*([A-Za-z_]\w*)\(', 1) ELSE 'Exception' END AS exception FROM {raw_task_events}""",
)
def exception_class(spark, folder):
    message = T.exception_message(F.col("exception"))
    return view(spark, folder, "raw_task_events").select(
        "event_id", message.alias("message"), T.exception_class(message).alias("exception")
    )


@query(
    "traceback_tail",
    f"SELECT doc_id, {cut('traceback', 4096)} AS event_tail, {cut('traceback', 2000)} AS record_tail FROM {{tracebacks}}",
)
def traceback_tail(spark, folder):
    text = F.col("traceback")
    return view(spark, folder, "tracebacks").select(
        "doc_id", T.tail(text, 4096).alias("event_tail"), T.tail(text, 2000).alias("record_tail")
    )


@query(
    "traceback_source",
    "SELECT event_id, coalesce(einfo_traceback, traceback, exception_traceback) AS traceback FROM {signal_rows}",
)
def traceback_source(spark, folder):
    source = T.first_traceback(F.col("einfo_traceback"), F.col("traceback"), F.col("exception_traceback"))
    return signals(spark, folder).select("event_id", source.alias("traceback"))


@query("retry_reason", "SELECT event_id, coalesce(reason, einfo) AS reason FROM {signal_rows}")
def retry_reason(spark, folder):
    return signals(spark, folder).select("event_id", T.retry_reason(F.col("reason"), F.col("einfo")).alias("reason"))


@query(
    "revoked_flags",
    "SELECT event_id, coalesce(terminated, false) AS terminated, signum, coalesce(expired, false) AS expired FROM {signal_rows}",
)
def revoked_flags(spark, folder):
    return signals(spark, folder).select(
        "event_id", P.flag(F.col("terminated")).alias("terminated"), "signum", P.flag(F.col("expired")).alias("expired")
    )


@query(
    "priority_to_int",
    """SELECT position, transport, CASE lower(trim(priority_label)) WHEN 'critical' THEN CASE WHEN transport = 'redis' THEN 0 ELSE 9 END
  WHEN 'high' THEN CASE WHEN transport = 'redis' THEN 3 ELSE 6 END WHEN 'normal' THEN CASE WHEN transport = 'redis' THEN 6 ELSE 3 END
  WHEN 'low' THEN CASE WHEN transport = 'redis' THEN 9 ELSE 0 END END AS priority,
  coalesce(transport NOT IN ('amqp', 'redis'), true) AS guessed, CAST(CASE WHEN position - 100 BETWEEN 0 AND 255 THEN position - 100 END AS int) AS raw_priority FROM {retry_requests}""",
)
def priority_to_int(spark, folder):
    label, transport = F.col("priority_label"), F.col("transport")
    return view(spark, folder, "retry_requests").select(
        "position",
        "transport",
        C.priority_of_label(label, transport).alias("priority"),
        C.priority_is_guess(label, transport).alias("guessed"),
        C.priority_of_number(F.col("position") - 100).alias("raw_priority"),
    )


@query(
    "transport_kind",
    """SELECT page_id, CASE WHEN lower(driver) LIKE '%redis%' THEN 'redis' WHEN lower(trim(driver)) IN ('amqp', 'pyamqp', 'librabbitmq', 'rabbitmq') THEN 'amqp'
  ELSE nullif(lower(trim(driver)), '') END AS transport FROM {broker_urls}""",
)
def transport_kind(spark, folder):
    return view(spark, folder, "broker_urls").select("page_id", C.transport_kind(F.col("driver")).alias("transport"))


@query(
    "broker_type",
    """SELECT page_id, CASE WHEN lower(url) LIKE '%redis%' THEN 'redis' WHEN lower(url) LIKE '%amqp%' OR lower(url) LIKE '%rabbit%' THEN 'amqp'
  WHEN lower(url) LIKE '%sqs%' THEN 'sqs' ELSE 'unknown' END AS broker FROM {broker_urls}""",
)
def broker_type(spark, folder):
    return view(spark, folder, "broker_urls").select("page_id", C.broker_type(F.col("url")).alias("broker"))


@query(
    "pool_type",
    "SELECT page_id, CASE WHEN pool IS NULL THEN 'prefork' WHEN lower(pool) LIKE '%solo%' THEN 'solo' ELSE lower(pool) END AS pool FROM {broker_urls}",
)
def pool_type(spark, folder):
    return view(spark, folder, "broker_urls").select("page_id", C.pool_type(F.col("pool")).alias("pool"))


ETA_SQL = """CASE WHEN eta IS NULL THEN NULL WHEN coalesce(isnan(try_cast(eta AS double)), true) OR try_cast(eta AS double) > 253402300799 THEN 'invalid'
  WHEN try_cast(eta AS double) - 1704067200 < -60 THEN 'too far past' WHEN try_cast(eta AS double) - 1704067200 > 31536000 THEN 'too far future' END"""


@query("eta_check", f"SELECT position, eta, {ETA_SQL} AS problem FROM {{retry_requests}}")
def eta_check(spark, folder):
    rows = view(spark, folder, "retry_requests").withColumn("at", P.number(F.col("eta")))
    return rows.select("position", "eta", C.eta_problem(F.col("eta"), F.col("at"), F.lit(NOW)).alias("problem"))


@query(
    "rate_check",
    """SELECT request_id, rate, CASE WHEN coalesce(task_name, '') = '' THEN 'task name required'
  WHEN NOT regexp_full_match(coalesce(rate, ''), '(?:0|[1-9][0-9]*(?:/[smh])?)') THEN 'invalid rate' END AS problem, rate = '0' AS clears FROM {rate_requests}""",
)
def rate_check(spark, folder):
    return view(spark, folder, "rate_requests").select(
        "request_id",
        "rate",
        C.rate_problem(F.col("task_name"), F.col("rate")).alias("problem"),
        C.clears_rate(F.col("rate")).alias("clears"),
    )


@query(
    "truncate_signature",
    "SELECT doc_id, CASE WHEN length(traceback) > 2000 THEN left(traceback, 1997) || '...' ELSE traceback END AS signature FROM {tracebacks}",
)
def truncate_signature(spark, folder):
    return view(spark, folder, "tracebacks").select("doc_id", T.short_signature(F.col("traceback")).alias("signature"))
