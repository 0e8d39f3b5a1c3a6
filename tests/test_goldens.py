"""Literal cases of every column function and small operator."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tasklens import constants as K
from tasklens.functions import control as C
from tasklens.functions import names as N
from tasklens.functions import payload as P
from tasklens.functions import text as T
from tasklens.operators import canonical as O
from tasklens.operators import envelope as E
from tasklens.operators import naming, planning, registry, state


def values(spark, rows, schema, *columns):
    """The columns over one row per input, in input order."""
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"_i int, {schema}")
    out = df.select("_i", *[c.alias(f"v{i}") for i, c in enumerate(columns)]).orderBy("_i").collect()
    return [r.v0 if len(columns) == 1 else tuple(r)[1:] for r in out]


def texts(spark, inputs, column):
    return values(spark, [(t,) for t in inputs], "x string", column)



def test_coerce_args(spark):
    cases = {
        None: None,
        "": None,
        "(1, 'x')": '[1, "x"]',
        "(42, 'hello')": '[42, "hello"]',
        "[1, 2, 3]": "[1, 2, 3]",
        "()": "[]",
        "[]": "[]",
        " [1]": None,
        "1, 2": "[1, 2]",
        "(1,": None,
        "{'k': 'v'}": None,
        "42": None,
        "[True, None, 1.5]": "[true, null, 1.5]",
        "[true]": None,
        "__import__('os').system('x')": None,
        "(b'x', {1: 2})": '["b\'x\'", {"1": 2}]',
        "[" * 300 + "]" * 300: None,
    }
    # Leading blanks are an indent, which the literal grammar allows to be stripped.
    cases[" [1]"] = "[1]"
    assert texts(spark, cases, P.coerce_args(F.col("x"))) == list(cases.values())


def test_coerce_kwargs(spark):
    cases = {
        None: None,
        "": None,
        "{}": {},
        "{ }": {},
        "{'customer_id': 42, 'email': 'a@b.c'}": {"customer_id": "42", "email": "a@b.c"},
        "{'k':": None,
        "['a', 'b']": None,
        "__import__('os').system('x')": None,
        "42": None,
        "{'a': None, 'b': [1, 'x'], 'c': False}": {"a": None, "b": '[1, "x"]', "c": "false"},
    }
    assert texts(spark, cases, P.coerce_kwargs(F.col("x"))) == list(cases.values())


def scrub(spark, kwargs, redact=None, keep=None):
    rows = [(kwargs, redact, keep)]
    schema = "k map<string,string>, r array<string>, p array<string>"
    return values(spark, rows, schema, P.scrub_kwargs(F.col("k"), F.col("r"), F.col("p")))[0]


def test_scrub_kwargs(spark):
    assert scrub(spark, {"user_id": "42", "password": "hunter2"}) == {"user_id": "42", "password": "[REDACTED]"}
    assert scrub(spark, {"custom_field": "v", "a": "b"}, ["custom_field"]) == {"custom_field": "[REDACTED]", "a": "b"}
    assert scrub(spark, {"user_id": "1", "email": "e"}, None, ["user_id"]) == {"user_id": "1"}
    assert scrub(spark, {"user_id": "1"}, ["user_id"], ["user_id"]) == {"user_id": "[REDACTED]"}
    assert scrub(spark, {"user_id": "1"}, None, []) == {}
    assert scrub(spark, None, ["a"], ["a"]) is None
    assert scrub(spark, {"a": None, "note": "token=abc"}) == {"a": None, "note": "token=[REDACTED]"}


def test_scrub_args_and_result(spark):
    rows = [("[1]", None), ("[1]", []), ("[1]", ["a"]), (None, ["a"])]
    out = values(spark, rows, "x string, keep array<string>", P.scrub_args(F.col("x"), F.col("keep")))
    assert out == ["[1]", "[REDACTED]", "[REDACTED]", None]
    rows = [("r", True), (None, True), ("r", False), ("r", None), (None, None)]
    out = values(spark, rows, "x string, hide boolean", P.scrub_result(F.col("x"), F.col("hide")))
    assert out == ["[REDACTED]", "[REDACTED]", "r", "r", None]


def test_scrub_text(spark):
    cases = {
        "password: hunter2, next\nline": "password: [REDACTED]\nline",
        "credit_card: 4111 1111 1111 1111": "credit_card: [REDACTED]",
        "password=a,b c": "password=[REDACTED]",
        'token = "abc.def" end': 'token = "[REDACTED]" end',
        "{'api_key': 'k1', 'a': 1}": "{'api_key': '[REDACTED]', 'a': 1}",
        "Authorization bearer abc.DEF-1": "Authorization bearer [REDACTED]",
        "amqp://user:pw@host/v": "amqp://[REDACTED]@host/v",
        "AKIA" + "A1" * 8: "[REDACTED]",
        '{"password": "my secret pass", "a": 1}': '{"password": "[REDACTED]", "a": 1}',
        '{"password": "a,b c", "b": {"ssn": "1 2", "credit_card": 4111, "n": 1}}': '{"password": "[REDACTED]", "b": {"ssn": "[REDACTED]", "credit_card": [REDACTED], "n": 1}}',
        "{'token': 'a \\' b; c', 'd': 2}": "{'token': '[REDACTED]', 'd': 2}",
        'secret="no end; of it': 'secret="[REDACTED]',
        "nothing here": "nothing here",
        None: None,
    }
    assert texts(spark, cases, T.scrub_text(F.col("x"))) == list(cases.values())


def test_runtime(spark):
    cases = {
        None: None, "1.5": 1500, "0.0015": 1, "-0.0015": -1, "2": 2000, " 3 ": 3000, "1e2": 100_000, ".5": 500,
        "bad": None, "nan": None, "inf": None, "-Infinity": None, "1e999": None, "1d": None, "": None, "0x10": None,
    }
    assert texts(spark, cases, P.runtime_ms(F.col("x"))) == list(cases.values())


def test_bad_runtimes_are_rejected(spark):
    rows = [("succeeded", "nan"), ("succeeded", "x"), ("succeeded", None), ("succeeded", "1"), ("failed", "x"), ("succeeded", "1e300")]
    df = spark.createDataFrame(rows, "kind string, runtime string")
    good, bad = E.absorb_bad_events(df)
    assert {tuple(r) for r in good.collect()} == {("succeeded", None), ("succeeded", "1"), ("failed", "x")}
    assert {(r.runtime, r.rejected) for r in bad.collect()} == {
        ("nan", "runtime is not a finite number"),
        ("x", "runtime is not a finite number"),
        ("1e300", "runtime is out of range"),
    }


def test_exception_class(spark):
    cases = {
        "ValueError('diagnostic failure')": "ValueError",
        "custom.errors.TaskError('failure')": "TaskError",
        "Unstructured failure": "Exception",
        " ValueError('x')": "Exception",
        "a..B(": "Exception",
        "Größe.Fehler(1)": "Fehler",
        "x" * 255 + "(": "x" * 255,
        "x" * 256 + "(": "Exception",
    }
    assert texts(spark, cases, T.exception_class(F.col("x"))) == list(cases.values())
    assert texts(spark, [None, "", "m"], T.exception_message(F.col("x"))) == ["Unknown error", "Unknown error", "m"]


def test_tail(spark):
    long = "a" * 8000 + "é" * 4000
    out = texts(spark, [long, "short", None, "b" * 4096, "b" * 4097], T.tail(F.col("x"), 4096))
    assert out == [K.TRACEBACK_MARKER + long[-4096:], "short", None, "b" * 4096, K.TRACEBACK_MARKER + "b" * 4096]
    assert len(out[0]) == len(K.TRACEBACK_MARKER) + 4096


def test_signature(spark):
    assert texts(spark, ["s" * 2000, "s" * 2001, None], T.short_signature(F.col("x"))) == ["s" * 2000, "s" * 1997 + "...", None]


@pytest.mark.parametrize(
    ("name", "task_id", "queue", "hint", "expected"),
    [
        ("app.t", "abcdefghij", "q", "h", "app.t"),
        ("", "abcdefghij", "q", " h ", "h"),
        (None, "abcdefghij", "q", "  ", "<unknown:q:abcdefgh>"),
        (None, "", "q", None, "<unknown:q>"),
        (None, "abc", "", None, "<unknown:abc>"),
        ("", None, None, "", "<unknown>"),
    ],
)
def test_placeholder(spark, name, task_id, queue, hint, expected):
    out = N.placeholder_name(F.col("n"), F.col("i"), F.col("q"), F.col("h"))
    assert values(spark, [(name, task_id, queue, hint)], "n string, i string, q string, h string", out) == [expected]


def test_is_placeholder(spark):
    cases = {"": True, None: True, "unknown": True, "<unknown:q>": True, "<unknown": True, "unknown.task": False, "a": False}
    assert texts(spark, cases, N.is_placeholder(F.col("x"))) == list(cases.values())


def test_priorities(spark):
    labels = [" Critical ", "high", "NORMAL", "low", "bogus", None]
    assert texts(spark, labels, C.priority_of_label(F.col("x"), F.lit("amqp"))) == [9, 6, 3, 0, None, None]
    mixed = ["7", " 255 ", "256", "-1", "7.5", "high", "bogus", None]
    assert texts(spark, mixed, C.coerce_priority(F.col("x"), F.lit("amqp"))) == [7, 255, None, None, None, 6, None, None]
    assert values(spark, [(7,), (256,)], "x int", C.coerce_priority(F.col("x"), F.lit("redis"))) == [7, None]
    assert texts(spark, labels, C.priority_of_label(F.col("x"), F.lit("redis"))) == [0, 3, 6, 9, None, None]
    assert texts(spark, labels, C.priority_of_label(F.col("x"), F.lit(None).cast("string"))) == [9, 6, 3, 0, None, None]
    assert texts(spark, ["sqs", None, "amqp", "redis"], C.priority_is_guess(F.lit("low"), F.col("x"))) == [True, True, False, False]
    assert values(spark, [(7,), (0,), (255,), (256,), (-1,), (None,)], "x int", C.priority_of_number(F.col("x"))) == [7, 0, 255, None, None, None]


def test_transports_and_pools(spark):
    drivers = {"redis": "redis", " RedisCluster ": "redis", "pyamqp": "amqp", "RabbitMQ": "amqp", "sqs": "sqs", "": None, None: None}
    assert texts(spark, drivers, C.transport_kind(F.col("x"))) == list(drivers.values())
    urls = {"REDIS://h": "redis", "amqp://rediscache": "redis", "rabbit://h": "amqp", "sqs://": "sqs", "memory://": "unknown", None: "unknown"}
    assert texts(spark, urls, C.broker_type(F.col("x"))) == list(urls.values())
    pools = {None: "prefork", "SOLO": "solo", "a.solo:Pool": "solo", "Gevent": "gevent", "": ""}
    assert texts(spark, pools, C.pool_type(F.col("x"))) == list(pools.values())


def test_eta(spark):
    now = 1_000_000_000
    cases = {
        None: None, str(now + 60): None, str(now - 60): None, str(now - 61): "too far past", str(now + 31_536_000): None,
        str(now + 31_536_001): "too far future", "x": "invalid", "nan": "invalid", "1e30": "invalid", str(now + 0.5): None,
    }
    assert texts(spark, cases, C.eta_problem(F.col("x"), P.number(F.col("x")), F.lit(now))) == list(cases.values())


def test_rates(spark):
    cases = {
        "0": None, "5": None, "10/s": None, "10/m": None, "10/h": None, "10/m\n": None,
        "0/s": "invalid rate", "05": "invalid rate", "10/d": "invalid rate", "": "invalid rate", None: "invalid rate",
        "-1": "invalid rate", "1.5": "invalid rate", "10/m\n\n": "invalid rate",
    }
    assert texts(spark, cases, C.rate_problem(F.lit("t"), F.col("x"))) == list(cases.values())
    assert texts(spark, ["", None], C.rate_problem(F.col("x"), F.lit("5"))) == ["task name required"] * 2


def test_envelopes(spark):
    bodies = [(1, '{"type": "a", "uuid": "u"}'), (2, '[{"type": "b"}, 5, {"type": "c"}]'), (3, "[]"), (4, "not json"), (5, '[{"type": "d"}]')]
    df = spark.createDataFrame(bodies, "message_id long, body string")
    rows = E.explode_envelopes(df).orderBy("message_id", "pos").collect()
    assert [(r.message_id, r.pos, r.type, r.poison) for r in rows] == [
        (1, 0, "a", False), (2, 0, "b", False), (2, 1, None, True), (2, 2, "c", False), (4, 0, None, True), (5, 0, "d", False),
    ]
    by_row = E.quarantine_poison(E.explode_envelopes(df))
    by_envelope = E.explode_envelopes(df, intact=True)
    kept = {(1, "a"), (2, "b"), (5, "d")}
    assert {(r.message_id, r.type) for r in by_row.collect()} == kept
    assert {(r.message_id, r.type) for r in by_envelope.collect()} == kept
    assert E.poison_cuts(E.explode_envelopes(df)).count() == 2
    loss = {r.message_id: (r.n_kept, r.n_lost) for r in E.envelope_loss(df).collect()}
    assert loss == {1: (1, 0), 2: (1, 2), 3: (0, 0), 4: (0, 1), 5: (1, 0)}


def test_unreadable_envelopes(spark):
    """Texts that look like events are none, and a body that is cut short is one poisoned row."""
    bodies = [(1, '["{\\"type\\": \\"a\\"}", {"type": "b"}]'), (2, '[{"type": "a"}, {"ty'), (3, '[{"type": "a"},]'), (4, '{"type": "a", '), (5, ""), (6, None), (7, '[{"type": "a"}, null, [{}]]')]
    df = spark.createDataFrame(bodies, "message_id long, body string")
    rows = E.explode_envelopes(df).orderBy("message_id", "pos").collect()
    assert [(r.message_id, r.pos, r.type, r.poison) for r in rows] == [
        (1, 0, None, True), (1, 1, "b", False), (2, 0, None, True), (3, 0, None, True), (4, 0, None, True),
        (5, 0, None, True), (6, 0, None, True), (7, 0, "a", False), (7, 1, None, True), (7, 2, None, True),
    ]
    loss = {r.message_id: (r.n_kept, r.n_lost) for r in E.envelope_loss(df).collect()}
    assert loss == {1: (0, 2), 2: (0, 1), 3: (0, 1), 4: (0, 1), 5: (0, 1), 6: (0, 1), 7: (1, 2)}


def test_hosts(spark):
    assert E.local_host(None, "  ") is None
    assert E.local_host(" a ", "b") == "a"
    df = spark.createDataFrame([("a",), ("A",), (None,), ("",)], "hostname string")
    assert E.filter_hostname(df, "a").count() == 1
    assert E.filter_hostname(df).count() == 4


def test_buffer(spark):
    df = spark.createDataFrame([(i, i) for i in range(5)], "event_id long, event_ts long")
    assert tuple(E.dropped_count(df, 2).first()) == (3, 2)
    assert tuple(E.dropped_count(df, 10).first()) == (0, 5)


def test_meta(spark):
    rows = [(-0.1, None), (1.1, None), (0.0, None), (1.0, "high"), (0.5, "urgent"), (float("nan"), None), (None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, sample_rate double, priority string")
    out = [r.problem for r in naming.validate_meta(df).orderBy("i").collect()]
    assert out == ["sample_rate", "sample_rate", None, None, "priority", "sample_rate", None]


def test_sampling_is_by_task(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("uuid"), F.lit(0.3).alias("sample_rate"), F.lit(False).alias("skip"))
    twice = naming.sample_events(df.union(df))
    counts = [r["count"] for r in twice.groupBy("uuid").count().collect()]
    assert set(counts) == {2}
    assert 450 < len(counts) < 750
    for rate, skip, kept in ((0.0, False, 0), (1.0, False, 2000), (1.0, True, 0)):
        some = df.withColumns({"sample_rate": F.lit(rate), "skip": F.lit(skip)})
        assert naming.sample_events(some).count() == kept


def test_broker_path_can_go_without_meta(spark):
    events = spark.createDataFrame([("t",)], "task_name string")
    meta = spark.createDataFrame([("t", "high")], "task_name string, priority string")
    assert naming.join_task_meta(events, meta).first().priority == "high"
    assert naming.join_task_meta(events, meta, apply=False).first().priority is None


def _broker_row(spark, **values_):
    base = {"event_id": 1, "event_ts": None, "uuid": "u1", "kind": "started", "task_name": "t", "hostname": "w", "runtime": None}
    row = {**base, **values_}
    schema = (
        "event_id long, event_ts timestamp_ntz, uuid string, kind string, task_name string, hostname string, runtime string, "
        "exception string, traceback string, result string, terminated boolean, signum int, expired boolean, "
        "redact_result boolean, tags array<string>, priority string, expected_duration_ms long, deadline_ms long"
    )
    names = [f.split()[0] for f in schema.split(", ")]
    return O.broker_events(spark.createDataFrame([tuple(row.get(n) for n in names)], schema)).first()


def test_broker_events(spark):
    failed = _broker_row(spark, kind="failed", exception="app.Bad('password=x1')", traceback="l\n" * 6000)
    assert failed.exception == "Bad"
    assert failed.exception_message == "app.Bad('password=[REDACTED]')"
    assert failed.traceback.startswith(K.TRACEBACK_MARKER)
    assert failed.worker == "w" and failed.queue is None and failed.result is None
    done = _broker_row(spark, kind="succeeded", result="42", runtime="1.2345", tags=["billing", "critical"], expected_duration_ms=200, deadline_ms=5000)
    assert (done.result, done.runtime_ms, done.tags, done.expected_duration_ms, done.deadline_ms) == ("42", 1234, ["billing", "critical"], 200, 5000)
    assert _broker_row(spark, kind="succeeded", redact_result=True).result == "[REDACTED]"
    assert _broker_row(spark, tags=[]).tags is None
    revoked = _broker_row(spark, kind="revoked", signum=9)
    assert (revoked.terminated, revoked.signum, revoked.expired) == (False, 9, False)
    assert _broker_row(spark, kind="retried", exception="later").reason == "later"


def test_registry(spark):
    loaded = spark.createDataFrame([("b", "m1", 1, True), ("celery.backend_cleanup", None, 2, True)], "name string, module string, seq long, loaded boolean")
    declared = spark.createDataFrame([("b", "m2", 9, False), ("a", "m3", 1, False), ("a", "m4", 2, False)], loaded.schema)
    merged = registry.merge_registry(registry.runtime_registry(loaded), declared).collect()
    assert [(r.name, r.module, r.loaded) for r in merged] == [("a", "m4", False), ("b", "m1", True)]
    assert registry.merge_registry(loaded.limit(0), declared.limit(0)).count() == 0
    files = [("b", "/x/tasks.py", False, "/x/tasks.py", 0), ("b", "/y/tasks.py", False, "/y/tasks.py", 0), ("c", "/x/tasks.py", False, "/x/tasks.py", 3), ("c", "/y/tasks.py", False, "/y/tasks.py", 1)]
    scanned = spark.createDataFrame(files, "name string, declared_in string, loaded boolean, file_order string, seq long")
    winners = registry.merge_registry(scanned)
    assert [(r.name, r.declared_in) for r in winners.collect()] == [("b", "/y/tasks.py"), ("c", "/y/tasks.py")]
    assert "file_order" not in winners.columns
    queues = values(spark, [("q", "o"), ("", "o"), (None, ""), (None, None)], "a string, b string", registry.default_queue(F.col("a"), F.col("b")))
    assert queues == ["q", "o", None, None]


def test_registry_diff(spark):
    old = spark.createDataFrame([("a", "q"), ("b", None), ("c", "q"), ("d", None)], "name string, queue string")
    new = spark.createDataFrame([("a", "q"), ("b", None), ("c", None), ("e", "q")], "name string, queue string")
    out = {(r.name, r.change) for r in registry.registry_diff(old, new).collect()}
    assert out == {("c", "updated"), ("d", "removed"), ("e", "added")}


def test_reconcile(spark):
    rows = [("1", "FAILURE", "line\n" * 900 + "ValueError: boom", "d"), ("2", "SUCCESS", "tb", "d"), ("3", "PENDING", None, "d"), ("4", None, None, None), ("5", "REVOKED", "", "d")]
    df = spark.createDataFrame(rows, "task_id string, state string, traceback string, date_done string")
    out = {r.task_id: r for r in state.reconcile_record(df).collect()}
    assert out["1"].exception.startswith(K.TRACEBACK_MARKER) and out["1"].exception.endswith("ValueError: boom")
    assert len(out["1"].exception) == len(K.TRACEBACK_MARKER) + 2000
    assert (out["2"].engine_state, out["2"].finished_at, out["2"].exception) == ("success", "d", None)
    assert (out["3"].engine_state, out["3"].finished_at) == ("pending", None)
    assert out["4"].engine_state == "unknown"
    assert (out["5"].engine_state, out["5"].exception) == ("failure", None)


def test_worker_conf(spark):
    secrets = {"broker_url": "x", "result_backend": "x", "security_key": "x", "redis_password": "x"}
    conf = {**dict.fromkeys(K.WORKER_CONF_KEYS, "1"), "task_acks_late": "False", "task_time_limit": None, **secrets}
    df = spark.createDataFrame([("w", conf), ("v", None)], "hostname string, conf map<string,string>")
    out = {r.hostname: r.conf for r in state.worker_conf_map(df).collect()}
    assert set(out["w"]) == set(K.WORKER_CONF_KEYS) and len(out["w"]) == 16
    assert out["w"]["task_acks_late"] == "False" and out["w"]["task_time_limit"] is None
    assert out["v"] == {}


def test_worker_details(spark):
    def reply(*hosts):
        return spark.createDataFrame([(h, f"r-{h}") for h in hosts], "hostname string, reply string")

    out = state.worker_details({"stats": reply("a", "b"), "conf": reply("c")})
    assert {(r.hostname, r.stats, r.active, r.conf) for r in out.collect()} == {
        ("a", "r-a", None, None), ("b", "r-b", None, None), ("c", None, None, "r-c"),
    }
    assert state.worker_details({"stats": reply("a", "b")}, "b").count() == 1
    maps = spark.createDataFrame([("a", {"pid": 7})], "hostname string, reply map<string,int>")
    lists = spark.createDataFrame([("a", ["t1", "t2"]), ("d", None)], "hostname string, reply array<string>")
    typed = state.worker_details({"stats": maps, "registered": lists})
    assert {(r.hostname, str(r.stats), str(r.registered)) for r in typed.collect()} == {
        ("a", "{'pid': 7}", "['t1', 't2']"), ("d", "None", "None"),
    }


def test_recycle_limits(spark):
    rows = [
        ("a", True, "prefork", 200, None, None, 250000), ("b", True, "solo", 200, None, None, None),
        ("c", False, "prefork", 200, None, None, None), ("d", True, "x.prefork:TaskPool", 0, None, 100, 0),
    ]
    schema = "hostname string, has_controller boolean, pool string, max_tasks_per_child int, max_memory_per_child int, worker_max_tasks_per_child int, worker_max_memory_per_child int"
    out = {tuple(r) for r in state.recycle_limits(spark.createDataFrame(rows, schema)).collect()}
    assert out == {("a", "worker_max_tasks_per_child", 200), ("a", "worker_max_memory_per_child", 250000)}


def test_known_queues(spark):
    rows = [("a", ["q1", "q2"], "d"), ("b", [], "d"), ("c", None, None)]
    df = spark.createDataFrame(rows, "app string, task_queues array<string>, task_default_queue string")
    assert {tuple(r) for r in state.known_queues(df).collect()} == {("a", "q1"), ("a", "q2"), ("b", "d"), ("c", "celery")}


REQUEST = "task_id string, supplied_name string, override_args string, override_kwargs string, eta string, priority_label string"


def test_retry_plan(spark):
    now = 1_000_000_000
    rows = [
        ("ok", "jobs.a", None, None, str(now + 60), "high"),
        ("late-event", "<unknown:late-eve>", None, None, None, None),
        ("nameless", "unknown", "[]", "{}", None, None),
        ("half", "jobs.a", "[]", None, None, None),
        ("both", "jobs.a", "[1]", "{}", None, "bogus"),
        ("gone", "jobs.a", None, None, None, None),
        ("old", "unknown", None, None, "1700000000", None),
        ("empty", "jobs.a", None, None, None, None),
        ("info", None, None, None, None, None),
    ]
    stored = [("ok", "x", "[1]", "{}", None), ("late-event", "jobs.real", "[]", "{}", None), ("empty", None, "[]", "{}", None), ("info", "", "[]", "{}", "jobs.info")]
    backend = spark.createDataFrame(stored, "task_id string, name string, args string, kwargs string, info_task string")
    plan = planning.retry_plan(spark.createDataFrame(rows, REQUEST), backend, F.lit(now))
    out = {r.task_id: (r.reason, r.name, r.priority) for r in plan.collect()}
    assert out == {
        "ok": (None, "jobs.a", 6),
        "late-event": (None, "jobs.real", None),
        "nameless": ("name unresolved", None, None),
        "half": ("inputs unresolved", None, None),
        "both": (None, "jobs.a", None),
        "gone": ("inputs unresolved", None, None),
        "old": ("eta too far future", None, None),
        "empty": (None, "jobs.a", None),
        "info": (None, "jobs.info", None),
    }


def test_retry_requests(spark):
    commands = spark.createDataFrame([(1, None), (2, 3), (3, 0), (4, 5)], "command_id long, max_ids int")
    ids = spark.createDataFrame([(1, 0), (1, 1), (1, 2), *[(2, i) for i in range(10)], (3, 0)], "command_id long, position long")
    out = {r.command_id: (r.status, r.requested, r.capped) for r in planning.retry_requests(commands, ids).collect()}
    assert out == {1: ("accepted", 3, False), 2: ("accepted", 3, True), 3: ("accepted", 0, True), 4: ("refused", 0, False)}


def test_purge(spark):
    rows = [(1, "a", False, None, "t"), (2, "a", True, None, "t"), (3, "x", False, "t", "t"), (4, "big", False, "t", "t"), (5, "a", False, "u", "t"), (6, "b", False, "t", "t"), (7, "x", True, None, None)]
    requests = spark.createDataFrame(rows, "request_id int, queue string, force boolean, confirm_token string, expected_token string")
    depths = spark.createDataFrame([("a", 2), ("b", 0), ("big", 1001)], "queue string, depth long")
    decisions = planning.purge_decision(requests, depths)
    out = {r.request_id: (r.allowed, r.reason, r.audit) for r in decisions.collect()}
    assert out == {
        1: (False, "no confirm token", False), 2: (True, None, True), 3: (False, "depth unknown", False),
        4: (False, "depth over threshold", False), 5: (False, "confirm token mismatch", False), 6: (True, None, False), 7: (True, None, True),
    }
    pending = spark.createDataFrame([("a",), ("a",), ("big",)], "queue string")
    assert {tuple(r) for r in planning.purge_effect(pending, decisions).collect()} == {("a", 2, 2), ("b", 0, 0), ("x", None, 0)}
    assert [r.queue for r in planning.surviving_messages(pending, decisions).collect()] == ["big"]


def test_outcomes(spark):
    rows = [("submit", "failed", True), ("submit", "failed", None), ("submit", "success", None), ("submit", "success", False)]
    log = spark.createDataFrame(rows, "action string, status string, indeterminate boolean")
    assert {tuple(r) for r in planning.command_outcomes(log).collect()} == {
        ("submit", "indeterminate", 1), ("submit", "failed", 1), ("submit", "success", 2),
    }


def test_task_depths(spark):
    from tasklens.operators.analytics import task_depths

    rows = [("r", None, "r"), ("a", "r", "r"), ("b", "a", "r"), ("c", "b", "r"), ("o", "missing", "r2"), ("p", "o", "r2"), ("x", "y", "c"), ("y", "x", "c"), ("z", "y", "c"), ("e", "", "e")]
    rows += [(f"n{i}", f"n{i - 1}" if i else None, "n0") for i in range(70)]
    out = {r.task_id: r.depth for r in task_depths(spark.createDataFrame(rows, "task_id string, parent_task_id string, root_task_id string")).collect()}
    expected = {"r": 0, "a": 1, "b": 2, "c": 3, "o": 0, "p": 1, "x": None, "y": None, "z": None, "e": 0}
    assert out == {**expected, **{f"n{i}": i for i in range(70)}}


def test_signal_kwargs_are_json(spark, sf):
    from tasklens.plans.catalog import canonical_signals

    rows = canonical_signals(spark, sf).filter("kwargs is not null and kwargs <> '{}'").limit(5).collect()
    assert rows and all(json.loads(r.kwargs)["password"] == "[REDACTED]" for r in rows)


def test_nested_payloads(spark):
    from tasklens.functions.nested import DEPTH, scrub_nested

    deep = '{"a":' * DEPTH + '{"k": 1}' + "}" * DEPTH
    cases = {
        '{"a": [{"Password": "x, y z"}, 1, null], "b": {"c": {"token": {"k": [1]}}}}': '{"a":[{"Password":"[REDACTED]"},1,null],"b":{"c":{"token":"[REDACTED]"}}}',
        '[{"ssn": 12, "n": "secret: s t"}, "plain"]': '[{"n":"secret: [REDACTED]","ssn":"[REDACTED]"},"plain"]',
        '{"quote\\"d": "a\\"b"}': '{"quote\\"d":"a\\"b"}',
        "{}": "{}",
        "[]": "[]",
        # What lies deeper than is walked is hidden whole.
        deep: '{"a":' * DEPTH + '"[REDACTED]"' + "}" * DEPTH,
        # No JSON: the rules for texts.
        "{'token': 'a b'}": "{'token': '[REDACTED]'}",
        "password=a,b c": "password=[REDACTED]",
        None: None,
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string")
    assert [r.out for r in df.select("i", scrub_nested(F.col("t")).alias("out")).orderBy("i").collect()] == list(cases.values())


def test_nested_keyword_arguments(spark):
    given = {"user": "1", "options": '{"auth": {"api_key": "k, l"}, "n": 2}'}
    assert scrub(spark, given) == {"user": "1", "options": '{"auth":{"api_key":"[REDACTED]"},"n":2}'}
