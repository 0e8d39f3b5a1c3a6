"""Running values: hot keys against plain windows, and both against sequential models."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tasklens.operators.analytics import retry_chains, task_runtime_stats, worker_load
from tasklens.operators.canonical import dedupe_transitions
from tasklens.operators.envelope import retain_latest_n
from tasklens.operators.naming import carry_task_name
from tasklens.operators.ordered import Running, running
from tasklens.operators.planning import circuit_break, retry_candidates, retry_summary

FEW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def _skewed(n=600, seed=7):
    """A third of all rows belong to one task, another part to none."""
    rng = random.Random(seed)
    kinds = ["started", "succeeded", "failed", "retried", "revoked"]
    rows = []
    for i in range(n):
        uuid = "hot" if rng.random() < 0.4 else rng.choice([None, "", *(f"t{j}" for j in range(40))])
        kind = rng.choice(kinds)
        name = rng.choice([None, "", f"n{rng.randrange(9)}"]) if kind == "started" else None
        rows.append((i, rng.randrange(n // 2), uuid, kind, name))
    return rows


SCHEMA = "event_id long, event_ts long, uuid string, kind string, name string"


def _model_names(rows):
    cache, out = {}, {}
    for event_id, _ts, uuid, kind, name in sorted(rows, key=lambda r: (r[1], r[0])):
        if kind == "started" and uuid and name:
            cache[uuid] = name
        out[event_id] = name or cache.get(uuid)
        if kind in ("succeeded", "failed", "revoked"):
            cache.pop(uuid, None)
    return out


@pytest.mark.parametrize("budget", [None, 20, 3])
def test_carried_names(spark, budget):
    rows = _skewed()
    out = carry_task_name(spark.createDataFrame(rows, SCHEMA), budget).collect()
    assert {r.event_id: r.carried_name for r in out} == _model_names(rows)


@FEW
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b", "", None]),
            st.sampled_from(["started", "succeeded", "retried", "revoked"]),
            st.sampled_from(["x", "y", "", None]),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_carried_names_model(spark, events):
    rows = [(i, i // 2, *e) for i, e in enumerate(events)]
    for budget in (None, 4):
        out = carry_task_name(spark.createDataFrame(rows, SCHEMA), budget).collect()
        assert {r.event_id: r.carried_name for r in out} == _model_names(rows)


def test_running_values_of_a_hot_key(spark):
    rows = [(1 if i % 3 else i, i, i % 7 or None) for i in range(3000)]
    df = spark.createDataFrame(rows, "key long, at long, value long")
    levels = [
        [Running("total", F.col("value"), "sum"), Running("before", F.col("value"), "sum", inclusive=False)],
        [Running("last", F.when(F.col("total") % 2 == 0, F.col("total")), "last")],
        [Running("last_before", F.col("last"), "last", inclusive=False)],
    ]
    plain = running(df, ["key"], ("at",), levels)
    cut = running(df, ["key"], ("at",), levels, key_row_budget=100)
    assert sorted(map(tuple, plain.collect()), key=repr) == sorted(map(tuple, cut.collect()), key=repr)
    assert plain.columns == cut.columns


LOG = "batch_id long, event_id long, event_ts long, outcome string, task_id string"


def _model_breaker(rows):
    final, streak, broken = {}, defaultdict(int), defaultdict(bool)
    for batch, event_id, _ts, outcome, _task in sorted(rows, key=lambda r: (r[2], r[1])):
        if broken[batch]:
            final[event_id] = "skipped"
            continue
        final[event_id] = outcome
        if outcome == "indeterminate":
            streak[batch] += 1
        elif outcome == "success":
            streak[batch] = 0
        broken[batch] = streak[batch] >= 3
    return final


@FEW
@given(st.lists(st.sampled_from(["success", "failed", "indeterminate"]), min_size=1, max_size=40), st.integers(1, 12))
def test_breaker_model(spark, outcomes, cap):
    rows = [(i % 2, i, i // 3, o, f"id{i % 9}") for i, o in enumerate(outcomes)]
    log = spark.createDataFrame(rows, LOG)
    expected = _model_breaker(rows)
    for budget in (None, 5):
        out = circuit_break(log, key_row_budget=budget).collect()
        assert {r.event_id: r.final_outcome for r in out} == expected
        _check_summary(retry_summary(log, cap, key_row_budget=budget).collect(), rows, cap)


def _check_summary(summary, rows, cap):
    for line in summary:
        batch = sorted((r for r in rows if r[0] == line.batch_id), key=lambda r: (r[2], r[1]))
        taken = batch[:cap]
        final = _model_breaker(taken)
        done = [(r[4], final[r[1]]) for r in taken if final[r[1]] != "skipped"]
        assert line.requested == len(taken)
        assert line.skipped == len(taken) - len(done)
        assert line.succeeded == len({t for t, o in done if o == "success"})
        assert line.failed == len({t for t, o in done if o != "success"})
        assert line.capped == (len(batch) > cap)
        trail = [o for _, o in done]
        streak = 0
        for o in trail:
            streak = 0 if o == "success" else streak + (o == "indeterminate")
        assert line.circuit_broken == (streak >= 3)


def test_candidates_of_a_hot_command(spark):
    rows = [(0 if i % 2 else i, i, f"t{i}", 50) for i in range(400)]
    ids = spark.createDataFrame(rows, "command_id long, position long, task_id string, max_ids int")
    taken = retry_candidates(ids).filter("command_id = 0").collect()
    assert sorted(r.position for r in taken) == [0, *range(1, 98, 2)]
    plan = retry_candidates(ids)._jdf.queryExecution().executedPlan().toString()
    # Cut before the shuffle, and once more after it.
    assert plan.count("WindowGroupLimit") == 2


def test_latest_rows(spark):
    df = spark.range(5).select(F.col("id").alias("event_id"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("event_ts"))
    assert [r.event_id for r in retain_latest_n(df, 2).orderBy("event_id").collect()] == [3, 4]
    spread = spark.range(3000).select(
        F.col("id").alias("event_id"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("event_ts"),
    )
    assert {r.event_id for r in retain_latest_n(spread, 130).collect()} == set(range(2870, 3000))
    assert retain_latest_n(spread, 5000).count() == 3000


def _canonical(spark, rows):
    return spark.createDataFrame(rows, "event_id string, task_id string, kind string, capture string, event_ts long, runtime_ms long, task_name string, worker string")


def test_other_uses_of_hot_keys(spark):
    rng = random.Random(3)
    rows = []
    for i in range(500):
        task = "hot" if i % 3 == 0 else rng.choice(["", *(f"t{j}" for j in range(30))])
        rows.append(
            (f"e{i:04}", task, rng.choice(["retried", "failed", "received"]), rng.choice(["broker", "signal"]),
             i // 2, rng.randrange(60), "slow" if i % 3 else "fast", f"w{i % 9}")
        )
    events = _canonical(spark, rows)
    timed = events.withColumn("event_ts", F.timestamp_seconds("event_ts"))
    for make in (
        lambda b: dedupe_transitions(events, b),
        lambda b: retry_chains(timed, b),
        lambda b: task_runtime_stats(events, key_row_budget=b),
    ):
        plain, cut = make(None), make(10)
        assert plain.columns == cut.columns
        assert sorted(map(tuple, plain.collect()), key=repr) == sorted(map(tuple, cut.collect()), key=repr)
    load = {r.worker: r for r in worker_load(events).collect()}
    counts = sorted({r.n_events for r in load.values()}, reverse=True)
    assert all(r.load_rank == counts.index(r.n_events) + 1 for r in load.values())
    kept = dedupe_transitions(events)
    # Events without a task id are no copies of each other.
    assert kept.filter("task_id = ''").count() == events.filter("task_id = ''").count()


def test_a_small_budget_makes_no_partitions_of_its_own(spark):
    """A hot key is cut into chunks within the budget, in tasks as many as the rows need."""
    rows = spark.range(4000).select((F.col("id") % 5).alias("key"), F.col("id").alias("at"))
    before = spark.sparkContext.statusTracker().getJobIdsForGroup("cut")
    spark.sparkContext.setJobGroup("cut", "cut")
    try:
        total = running(rows, ["key"], ("at",), [[Running("total", F.lit(1), "sum")]], key_row_budget=2)
        got = {(r.key, r.at): r.total for r in total.collect()}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.sparkContext.setLocalProperty("spark.job.description", None)
    tracker = spark.sparkContext.statusTracker()
    stages = {s for job in set(tracker.getJobIdsForGroup("cut")) - set(before) for s in tracker.getJobInfo(job).stageIds}
    assert got == {(i % 5, i): i // 5 + 1 for i in range(4000)}
    tasks = [info.numTasks for info in map(tracker.getStageInfo, stages) if info]
    assert tasks and max(tasks) <= 64
