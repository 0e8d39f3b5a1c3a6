"""Streams over several batches give what the batch operators give over everything."""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tasklens.operators.analytics import task_latest_state
from tasklens.operators.envelope import mappable, route_event_types
from tasklens.operators.naming import carry_task_name
from tasklens.plans.catalog import canonical
from tasklens.plans.streams import _append_in_order
from tasklens.sources.readers import stream_task_events, with_instant
from tasklens.sources.views import view
from tasklens.streaming import runs as S
from tasklens.streaming.late import counted_sessions, counted_windows
from tasklens.streaming.ordered import _NamesInFrames, _NamesInOrder, named_in_order
from tasklens.streaming.pairing import pair_captures


def _in_batches(spark, sf, tmp_path, n=3):
    """The raw events in arrival order as n files, and the stream that reads one file per batch."""
    raw = view(spark, sf, "raw_task_events")
    path = str(tmp_path / "arrivals")
    total = raw.count()
    for i in range(n):
        part = raw.filter((F.col("event_id") >= i * total // n) & (F.col("event_id") < (i + 1) * total // n))
        part.coalesce(1).write.mode("append").parquet(path)
    return raw, stream_task_events(spark, path, maxFilesPerTrigger=1)


def test_names_are_carried_across_batches(spark, sf, tmp_path):
    raw, stream = _in_batches(spark, sf, tmp_path)
    task = F.col("uuid").isin([f"{u}-{k}" for u in range(4) for k in range(10)]) | (F.col("event_id") % 50 == 0)

    def good(df):
        return route_event_types(df).filter(mappable() & task)

    batch = good(raw).withColumn("uuid", F.when(F.col("event_id") % 50 != 0, F.col("uuid")))
    arriving = good(stream).withColumn("uuid", F.when(F.col("event_id") % 50 != 0, F.col("uuid")))
    columns = ("event_id", "event_ts", "uuid", "kind", "name")
    expected = {(r.event_id, r.carried_name) for r in carry_task_name(batch).collect()}
    for ttl in (24.0, None):
        out = S.carried(arriving.select(*columns), ttl)
        assert {(r.event_id, r.carried_name) for r in out.collect()} == expected
    assert any(name for _, name in expected)


def test_latest_state(spark, sf, tmp_path):
    _raw, stream = _in_batches(spark, sf, tmp_path)
    streamed = S.latest_state(route_event_types(stream).withColumnRenamed("uuid", "task_id"))
    everything = route_event_types(view(spark, sf, "raw_task_events")).select(
        F.col("uuid").alias("task_id"), "kind", "event_ts", "event_id", *[F.lit(None).cast("string").alias(c) for c in ("worker", "queue", "task_name")]
    )
    columns = ("task_id", "kind", "first_ts", "last_ts", "n_events")
    assert set(streamed.select(*columns).collect()) == set(task_latest_state(everything).select(*columns).collect())


def test_window_totals(spark, sf, tmp_path):
    raw, stream = _in_batches(spark, sf, tmp_path)
    streamed = S.window_totals(with_instant(stream), ("type",), "1 hour")
    batch = raw.groupBy(F.date_trunc("hour", "event_ts").alias("window_start"), "type").agg(F.count("*").alias("n"))
    assert set(map(tuple, streamed.collect())) == set(map(tuple, batch.collect()))


def _files(spark, rows, schema, path, key="file"):
    """Rows as one file per number of ``key``, in order, and the stream that reads a file per batch."""
    df = spark.createDataFrame(rows, schema)
    for (i,) in df.select(key).distinct().orderBy(key).collect():
        df.filter(F.col(key) == i).drop(key).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.drop(key).schema).option("maxFilesPerTrigger", 1).parquet(path)


EVENTS = "event_id long, at long, uuid string, kind string, name string, file int"


def _instants(df):
    return df.withColumn("event_ts", F.timestamp_micros("at")).drop("at")


def test_names_in_any_order(spark, tmp_path):
    """Whatever the order of arrival, a task's events are named in their own; copies and ties change nothing."""
    rng = random.Random(11)
    minute = 60_000_000
    rows = []
    for i in range(220):
        # Many events share their time.
        kind = rng.choice(["started", "started", "retried", "succeeded", "failed"])
        name = rng.choice(["a", "b", "", None]) if kind == "started" else rng.choice(["own", None, None, None])
        rows.append((i, 1_700_000_000_000_000 + i // 3 * 7 * minute, rng.choice(["t1", "t2", "t3", "", None]), kind, name, rng.randint(0, 3)))
    rows += [(*r[:5], min(3, r[5] + 1)) for r in rows[::9]]
    clock = (-1, 4_000_000_000_000_000, None, "clock", None, 9)
    stream = _instants(_files(spark, [*rows, clock], EVENTS, str(tmp_path / "in")))
    named = named_in_order(stream, "30 hours", "1 hour", None)
    with S.settings(spark, S.stateful(spark)):
        got = S.append_all(named, "names").select("event_id", "carried_name").collect()
    batch = _instants(spark.createDataFrame([r[:5] for r in rows], EVENTS.removesuffix(", file int"))).dropDuplicates(["event_id"])
    expected = {(r.event_id, r.carried_name) for r in carry_task_name(batch).collect()}
    assert {tuple(r) for r in got} == expected
    # Copies came out as copies.
    assert len(got) == len(rows)


def test_names_are_forgotten_and_late_events_dropped(spark, tmp_path):
    hour = 3_600_000_000
    rows = [
        (1, 10 * hour, "t", "started", "a", 0), (2, 11 * hour, "t", "retried", None, 0), (3, 20 * hour, "t", "retried", None, 1),
        (4, 60 * hour, "u", "started", "b", 1), (5, 9 * hour, "t", "started", "late", 3), (-1, 9000 * hour, None, "clock", None, 4),
    ]
    # A batch between, as rows may come as late as the batch before last allows.
    rows.append((6, 61 * hour, "u", "retried", None, 2))
    stream = _instants(_files(spark, rows, EVENTS, str(tmp_path / "in")))
    with S.settings(spark, S.stateful(spark)):
        got = S.append_all(named_in_order(stream, "2 hours", "1 hour", "5 hours"), "names").collect()
    assert {(r.event_id, r.carried_name) for r in got} == {(1, "a"), (2, "a"), (3, None), (4, "b"), (6, "b")}


def _late_rows(spark, tmp_path):
    minute = 60_000_000
    base = 1_700_000_000_000_000 // (10 * minute) * 10 * minute
    rng = random.Random(4)
    rows = [(i, base + rng.randint(0, 300) * minute, rng.choice("ab"), i // 60) for i in range(240)]
    rows.append((999, None, "a", 2))
    stream = _instants(_files(spark, rows, "event_id long, at long, host string, file int", str(tmp_path / "in")))
    return rows, stream, base, minute


def test_windows_and_late_rows_are_all_rows(spark, tmp_path):
    rows, stream, _base, minute = _late_rows(spark, tmp_path)
    counted = counted_windows(stream, ("host",), "10 minutes", "30 minutes")
    late, on_time, mark = set(), {}, None
    for file in range(5):
        batch = [r for r in rows if r[3] == file]
        for i, at, host, _ in batch:
            if at is None or (mark is not None and at // (10 * minute) * 10 * minute + 10 * minute <= mark):
                late.add(i)
            else:
                key = (at // (10 * minute) * 10 * minute, host)
                on_time[key] = on_time.get(key, 0) + 1
        mark = max([mark or 0, *[r[1] - 30 * minute for r in batch if r[1] is not None]])
    assert {r.event_id for r in counted.late.collect()} == late and len(late) > 10
    got = counted.counts.select(F.unix_micros("window_start").alias("w"), "host", "n", "closed").collect()
    assert {(r.w, r.host): r.n for r in got} == on_time
    assert all(r.closed == (r.w + 10 * minute <= mark) for r in got) and {r.closed for r in got} == {True, False}
    assert sum(r.n for r in got) + len(late) == len(rows)


def test_sessions_over_batches(spark, tmp_path):
    rows, stream, _base, minute = _late_rows(spark, tmp_path)
    # So long a delay that nothing but the row without a time is late.
    counted = counted_sessions(stream, ("host",), "7 minutes", "20 hours")
    expected = set()
    for host in "ab":
        times = sorted(r[1] for r in rows if r[2] == host and r[1] is not None)
        start, n = times[0], 0
        for at, after in zip(times, [*times[1:], None], strict=True):
            n += 1
            if after is None or after > at + 7 * minute:
                expected.add((host, start, at + 7 * minute, n, False))
                start, n = after, 0
    got = counted.counts.select("host", F.unix_micros("session_start"), F.unix_micros("session_end"), "n", "closed").collect()
    assert {tuple(r) for r in got} == expected
    assert [r.event_id for r in counted.late.collect()] == [999]


def test_capture_paths_pair_up(spark, tmp_path):
    """Near copies of one task and kind are one row, the owner's; what stands alone on either path stays."""
    second = 1_000_000
    sides = {
        "broker": [("b1", "t", 10, "failed", 0), ("b2", "t", 20, "started", 0), ("b3", "", 30, "failed", 1), ("b4", "u", 40, "received", 1)],
        "signal": [("s1", "t", 12, "failed", 1), ("s2", "t", 26, "started", 0), ("s3", "", 30, "failed", 1), ("s4", "u", 38, "received", 0)],
    }
    streams = []
    for name, rows in sides.items():
        rows = [(i, t, at * second, kind, name, file) for i, t, at, kind, file in rows] + [(f"clock {name}", "", 9_000_000 * second, "clock", name, 9)]
        schema = "event_id string, task_id string, at long, kind string, capture string, file int"
        streams.append(_instants(_files(spark, rows, schema, str(tmp_path / name))))
    with S.settings(spark, S.stateful(spark)):
        got = S.append_all(pair_captures(*streams, "5 seconds", "1 hour"), "pairs").collect()
    assert {(r.event_id, r.broker_id, r.signal_id) for r in got} == {
        ("b1", "b1", "s1"), ("b2", "b2", None), ("s2", None, "s2"), ("b3", "b3", None), ("s3", None, "s3"), ("s4", "b4", "s4")
    }


def test_a_join_keeps_one_store_per_partition(spark, tmp_path):
    """Both sides of a partition are in one store, whose rows are not looked up just to be counted."""
    schema = "event_id string, task_id string, at long, kind string, capture string, file int"
    rows = {n: [(f"{n}{i}", f"t{i}", i * 1_000_000, "failed", n, 0) for i in range(50)] for n in ("broker", "signal")}
    streams = [_instants(_files(spark, r, schema, str(tmp_path / n))) for n, r in rows.items()]
    with S.settings(spark, S.stateful(spark)):
        run = (
            pair_captures(*streams).writeStream.format("parquet")
            .option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "checkpoint"))
            .trigger(availableNow=True)
            .start()
        )
        run.awaitTermination()
    state = run.recentProgress[0]["stateOperators"][0]
    assert state["numStateStoreInstances"] == state["numShufflePartitions"] == spark.sparkContext.defaultParallelism
    assert state["numRowsTotal"] == 0


def test_loss_per_batch(spark, tmp_path):
    """Envelopes that lose elements are counted as envelopes; nothing after a poisoned element is stored."""
    ok, sent = '{"type": "task-started", "uuid": "u"}', '{"type": "task-sent"}'
    bodies = [f"[{ok}, 17, {ok}]", f"[{ok}, {sent}]", "nonsense", "[]", ok, f"[17, {ok}]", f"[{ok}]"]
    rows = [(i, body, i // 3) for i, body in enumerate(bodies)]
    stream = _files(spark, rows, "message_id long, body string, file int", str(tmp_path / "in"))
    got = S.loss_metrics(stream, str(tmp_path / "out")).orderBy("batch_id").collect()
    assert [tuple(r) for r in got] == [(0, 3, 2, 3, 1), (1, 3, 1, 2, 0), (2, 1, 0, 0, 0)]
    assert sorted(r.message_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [0, 1, 4, 6]


def test_sinks_repeat_without_harm(spark, tmp_path):
    """A batch that runs twice replaces its own folder."""
    path = str(tmp_path / "in")
    spark.range(10).write.parquet(path)
    stream = spark.readStream.schema("id long").parquet(path)

    def twice(batch):
        return batch

    out = S.each_batch(stream, "twice", twice)
    assert out.count() == 10 and set(out.columns) == {"id", "batch_id"}


def test_late_states_merge(spark):
    rows = [("t", ("2024-01-01 00:00:02", 2), "failed"), ("t", ("2024-01-01 00:00:01", 1), "started")]
    partials = spark.createDataFrame(rows, "task_id string, place struct<event_ts:string,event_id:long>, kind string").select(
        "task_id", F.struct("place", "kind").alias("latest"), F.col("place.event_ts").alias("first_ts"), F.lit(1).alias("n_events")
    )
    merged = S.merged_states(partials).first()
    assert (merged.latest.kind, merged.first_ts, merged.n_events) == ("failed", "2024-01-01 00:00:01", 2)


def test_stream_and_batch_share_the_mapping(spark, sf):
    """The canonical columns are the same either way."""
    stream = S.normalised(S.stream_view(spark, sf, "envelopes"))
    assert stream.schema.names == canonical(spark, sf).schema.names


def test_appended_events_have_the_batch_layout(spark, sf, tmp_path):
    stream = S.normalised(S.stream_view(spark, sf, "envelopes"))
    S.append_events(stream, str(tmp_path / "events"), str(tmp_path / "checkpoint")).awaitTermination()
    back = spark.read.parquet(str(tmp_path / "events"))
    assert set(back.columns) == {*canonical(spark, sf).columns, "event_date"}
    assert {r.kind for r in back.select("kind").distinct().collect()} == {"started", "failed"}


def test_state_is_called_per_group_not_per_task():
    """Hundreds of tasks of one group cost a few calls on the state, and each task keeps its own name."""
    calls = []

    class Kept:
        """A list state and a value state in one, that counts what is asked of it."""

        def __init__(self):
            self.value = None

        def get(self):
            calls.append("get")
            return self.value if self.single else iter(self.value or [])

        def put(self, value):
            calls.append("put")
            self.value = value

        update = put

        def clear(self):
            self.put(None)

        def appendList(self, rows):
            self.put([*(self.value or []), *rows])

        def appendValue(self, row):
            self.appendList([row])

    class Handle:
        def getListState(self, name, schema):
            kept = Kept()
            kept.single = False
            return kept

        def getValueState(self, name, schema):
            kept = Kept()
            kept.single = True
            return kept

        def registerTimer(self, at):
            calls.append("timer")

    class Expired:
        def getExpiryTimeInMs(self):
            return 3_600_000

    held = StructType().add("event_id", "long").add("uuid", "string").add("kind", "string").add("name", "string").add("_at_us", "long")
    processor = _NamesInOrder(held, ("event_id",), 3_600_000, None)
    processor.init(Handle())
    start, later = Row(*held.names), []
    for task in range(300):
        later += [start(2 * task, f"t{task}", "started", f"n{task}", 1000), start(2 * task + 1, f"t{task}", "retried", None, 2000)]
    assert list(processor.handleInputRows((0,), iter(later), None)) == []
    named = {r.event_id: r.carried_name for r in processor.handleExpiredTimer((0,), None, Expired())}
    assert named == {i: f"n{i // 2}" for i in range(600)}
    assert len(calls) < 30


class _Store:
    """The state of one group, and what was asked of it."""

    def __init__(self):
        self.calls, self.timers = [], []

    def _kept(self, name, single):
        store = self

        class Kept:
            value = None if single else ()

            def get(self):
                store.calls.append((name, "get"))
                return self.value if single else iter(self.value)

            def update(self, value):
                store.calls.append((name, "put"))
                self.value = value

            put = update

            def clear(self):
                self.update(None if single else ())

            def appendValue(self, row):
                self.update((*self.value, row))

        return Kept()

    def getListState(self, name, schema):
        return self._kept(name, False)

    def getValueState(self, name, schema):
        return self._kept(name, True)

    def registerTimer(self, at):
        self.timers.append(at)


class _Time:
    def __init__(self, at):
        self.at = at

    def getExpiryTimeInMs(self):
        return self.at

    getCurrentWatermarkInMs = getExpiryTimeInMs


_HELD = StructType().add("event_id", "long").add("uuid", "string").add("kind", "string").add("name", "string").add("_at_us", "long").add("place", "long")


def _named_one_by_one(rows, slot_ms, remember_ms):
    """What each row (by its place) is named, by a walk over all of a group's rows; they come in the order of arrival."""
    out, names = {}, {}
    for slot in sorted({r[4] // 1000 // slot_ms for r in rows}):
        due = [(i, r) for i, r in enumerate(rows) if r[4] // 1000 // slot_ms == slot]
        due.sort(key=lambda x: (x[1][1] or "", x[1][4], x[1][0] is not None, x[1][0] or 0))
        at_task, last, given = None, None, None
        for i, (event, task, kind, name, at) in due:
            if (task or "") != at_task:
                at_task, last, given = task or "", None, None
            memory = names.get(at_task)
            if event != last:
                if memory and memory[1] is not None and memory[1] <= at // 1000:
                    memory = None
                given = name or (memory[0] if memory else None)
                if kind in ("succeeded", "failed", "revoked"):
                    memory = None
                elif kind == "started" and name and at_task:
                    memory = (name, None if remember_ms is None else at // 1000 + remember_ms)
                names[at_task] = memory
            last, out[i] = event, given
    return out


def test_names_by_columns_are_names_one_by_one():
    rng = random.Random(5)
    hour = 3_600_000
    for remember in (None, 90 * 60_000):
        for _ in range(40):
            rows = []
            for i in range(rng.randint(1, 90)):
                kind = rng.choice(["started", "started", "retried", "succeeded", "failed", None])
                name = rng.choice(["a", "b", "", None])
                rows.append((rng.choice([i, i, i, None]), rng.choice(["t", "u", "v", "", None]), kind, name, rng.randint(-5, 40) * 600_000_000))
            rows += [rows[rng.randrange(len(rows))] for _ in range(10)]
            rng.shuffle(rows)
            store, got = _Store(), {}
            processor = _NamesInOrder(_HELD, ("event_id",), hour, remember)
            processor.init(store)
            row = Row(*_HELD.names)
            # Slots that are over come out before later ones arrive.
            for times in (range(-6, 12), range(12, 24), range(24, 60)):
                arriving = [row(*r, i) for i, r in enumerate(rows) if r[4] // 600_000_000 in times]
                if arriving:
                    assert list(processor.handleInputRows((0,), iter(arriving), None)) == []
                mark = times.stop // 6 * hour
                for at in sorted(t for t in store.timers if t <= mark):
                    for r in processor.handleExpiredTimer((0,), _Time(mark), _Time(at)):
                        got[r.place] = r.carried_name
                        assert r.settled_at.timestamp() * 1000 == (r._at_us // 1000 // hour + 1) * hour + 1
                store.timers = [t for t in store.timers if t > mark]
            assert got == _named_one_by_one(rows, hour, remember)


def test_names_are_read_and_written_once_for_all_slots_that_are_over():
    store = _Store()
    processor = _NamesInFrames(_HELD, ("event_id",), 3_600_000, None)
    processor.init(store)
    rows = [(10 * h + t, f"t{t}", "started" if h == 0 else "retried", f"n{t}" if h == 0 else None, h * 3_600_000_000 + t, t) for h in range(5) for t in range(8)]
    assert list(processor.handleInputRows((0,), iter([pd.DataFrame(rows)]), None)) == []
    assert store.timers == [3_600_000 * h for h in range(1, 6)]
    frames = [f for at in store.timers[:4] for f in processor.handleExpiredTimer((0,), _Time(4 * 3_600_000), _Time(at))]
    assert sorted(n for f in frames for n in f["carried_name"]) == sorted(f"n{t}" for t in range(8) for _ in range(4))
    # Once for the slots that the watermark has passed, once for the one that ends with it.
    assert [c for c in store.calls if c[0] == "names"].count(("names", "get")) <= 2
    assert [c for c in store.calls if c[0] == "names"].count(("names", "put")) == 1


def test_values_beside_names_come_back_as_they_were(spark, tmp_path):
    """Whole numbers beside nulls, times, nested values: nothing is rounded; a time far off stops nothing."""
    rows = spark.range(8).selectExpr(
        "id AS event_id", "timestamp_micros(CASE WHEN id = 7 THEN 32503680000000000 ELSE 1700000000000000 + id END) AS event_ts",
        "'t' AS uuid", "'retried' AS kind", "CASE WHEN id % 2 = 0 THEN 'a' END AS name",
        "CASE WHEN id % 2 = 0 THEN 9007199254740993 + id END AS whole", "CASE WHEN id % 3 = 0 THEN id > 3 END AS flag",
        "CASE WHEN id % 2 = 0 THEN timestamp_micros(1700000000123456 + id) END AS instant", "TIMESTAMP_NTZ '3024-02-03 04:05:06.789012' AS plain",
        "CAST(id / 7 AS double) AS part", "CAST('nan' AS float) AS no_number", "CAST(id / 8 AS decimal(20, 5)) AS exact", "DATE '0044-03-15' AS day",
        "encode('x', 'utf-8') AS raw", "array('a', NULL, 'b') AS list", "named_struct('n', 9007199254740993, 's', CAST(NULL AS string)) AS nested",
    )
    path = str(tmp_path / "in")
    rows.coalesce(1).write.parquet(path)
    stream = spark.readStream.schema(rows.schema).parquet(path)
    with S.settings(spark, S.stateful(spark)):
        got = S.append_all(named_in_order(stream, "1 day", "1 hour", None), "values")
    kept = rows.columns
    assert {(r.event_id, r.carried_name) for r in got.collect()} == {(i, "a" if i % 2 == 0 else None) for i in range(7)}
    assert got.columns == [*[c for c in kept if c != "event_ts"], "carried_name", "settled_at", "event_ts"]
    assert got.select(*kept).dtypes == rows.dtypes
    assert list(map(str, got.select(*kept).orderBy("event_id").collect())) == list(map(str, rows.filter("event_id < 7").orderBy("event_id").collect()))


def test_a_batch_is_many_files_and_ends_with_its_number(spark):
    rows = spark.range(4000).select("id", F.when(F.col("id") < 2500, 0).when(F.col("id") < 3990, 1).otherwise(3).alias("file"))
    path, files = _append_in_order(rows.unionByName(spark.createDataFrame([(-2, None)], "id long, file int")), "files", 500, clock=[(-1,)])
    assert files == 5
    stream = stream_task_events(spark, path, schema="id long", maxFilesPerTrigger=files)
    got = S.each_batch(stream, "batches", lambda batch: batch).groupBy("batch_id").agg(F.min("id"), F.max("id"), F.count("*")).collect()
    assert sorted(map(tuple, got)) == [(0, 0, 2499, 2500), (1, 2500, 3989, 1490), (2, 3990, 3999, 10), (3, -1, -1, 1)]
