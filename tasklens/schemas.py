"""Explicit schemas, so that no read has to infer one."""

from __future__ import annotations

# The driver's tables.
TABLES = {
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

# One lifecycle event inside an envelope, as its producer writes it.
ENVELOPE_EVENT = (
    "type string, uuid string, name string, hostname string, args string, kwargs string, queue string, "
    "runtime string, result string, exception string, traceback string, terminated boolean, signum int, "
    "expired boolean"
)

# The same with the producer's own clock, in seconds.
TIMED_EVENT = f"{ENVELOPE_EVENT}, timestamp double"
# What arrives: a body and when it did.
ENVELOPE = "message_id bigint, ingest_ts timestamp_ntz, body string"

# A lifecycle event as a row: its place in the stream plus the envelope fields.
RAW_EVENT = (
    "event_id bigint, event_ts timestamp_ntz, message_id bigint, pos int, uuid string, type string, name string, "
    "hostname string, runtime string, exception string, poison boolean, args string, kwargs string, queue string, "
    "result string, traceback string, terminated boolean, signum int, expired boolean"
)

SIGNAL_REQUEST = (
    "struct<id:string,task_id:string,task:string,args:string,kwargs:string,"
    "delivery_info:map<string,string>,parent_id:string,root_id:string>"
)
SIGNAL_EVENT = (
    f"event_id bigint, event_ts timestamp_ntz, signal string, task_id string, request {SIGNAL_REQUEST}, "
    "task string, args string, kwargs string, state string, retval string, exception_type string, "
    "exception_message string, einfo_traceback string, traceback string, exception_traceback string, "
    "reason string, einfo string, terminated boolean, signum int, expired boolean, kwargs_task_id string"
)

TASK_META = (
    "task_name string, redact_kwargs array<string>, keep_kwargs array<string>, redact_result boolean, "
    "tags array<string>, priority string, expected_duration_ms bigint, deadline_ms bigint, skip boolean, "
    "sample_rate double"
)

CANONICAL_EVENT = (
    "event_id string, engine string, task_id string, kind string, event_ts timestamp_ntz, ingest_ts timestamp_ntz, "
    "capture string, task_name string, queue string, worker string, tags array<string>, priority string, "
    "expected_duration_ms bigint, deadline_ms bigint, args string, kwargs string, parent_task_id string, "
    "root_task_id string, result string, runtime_ms bigint, exception string, exception_message string, "
    "traceback string, reason string, terminated boolean, signum int, expired boolean"
)

REGISTRY = (
    "name string, module string, engine string, queue string, signature string, declared_in string, "
    "loaded boolean, tags array<string>, seq bigint"
)

SOURCE_FILE = "path string, length bigint, content binary"
