"""The shape of the plans: what is shuffled, pushed down, broadcast and sent to Python."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tasklens.operators import envelope, naming, planning
from tasklens.plans import QUERIES
from tasklens.plans.catalog import named_events
from tasklens.sources.readers import table

STREAMED = {k for k in QUERIES if k.startswith("stream_")}
# These write, or walk a graph, before they return a table.
EAGER = {"read_task_events", "read_signal_events", "write_events", "task_tree"}
PYTHON = {"coerce_args", "coerce_kwargs", "scan_definitions", "events_received"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(set(QUERIES) - STREAMED - EAGER))
def test_no_query_pairs_everything_or_leaves_the_jvm(spark, sf, key):
    text = plan(QUERIES[key](spark, sf))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert ("EvalPython" in text or "InPandas" in text or "MapInArrow" in text) == (key in PYTHON)
    # A single partition is right for whole-table totals, and for a rank over workers while they are few.
    if "SinglePartition" in text:
        assert key in {"poison_count", "dropped_events", "worker_load", "worker_load_sketch"}


def _exchanges(text: str) -> list[str]:
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)


def _names(columns: str) -> str:
    return ",".join(re.sub(r"#\w+", "", c).strip() for c in columns.split(",")[:-1])


def test_naming_shuffles_events_once(spark, sf):
    exchanges = [_names(e) for e in _exchanges(plan(named_events(spark, sf)))]
    # The other one is of the poisoned messages alone.
    assert sorted(exchanges) == ["message_id", "uuid,_apart"]


def test_breaker_shuffles_once(spark, sf):
    log = table(spark, sf, "events").select(
        F.col("user_id").alias("batch_id"), "event_id", F.col("ts").alias("event_ts"), F.col("event_type").alias("outcome")
    )
    assert len(_exchanges(plan(planning.circuit_break(log)))) == 1
    summary = planning.retry_summary(log.withColumn("task_id", F.col("event_id").cast("string")))
    assert len(_exchanges(plan(summary))) == 1


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.sql(
        "SELECT 1L AS event_id, TIMESTAMP_NTZ '2024-01-01' AS event_ts, 'u' AS uuid, 'task-started' AS type, 'n' AS name, 'h' AS hostname, 'x' AS args"
    ).write.parquet(path)
    raw = spark.read.parquet(path)
    rows = envelope.filter_hostname(envelope.route_event_types(raw), "h")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    text = plan(naming.carry_task_name(rows).select("uuid", "carried_name"))
    assert "EqualTo(hostname,h)" in text and "In(type" in text
    assert "args" not in re.search(r"ReadSchema: struct<(.*?)>", text).group(1)


def test_metadata_is_not_forced_to_be_broadcast(spark, sf):
    events = spark.range(10).select(F.concat(F.lit("t"), F.col("id")).alias("task_name"))
    meta = events.withColumn("priority", F.lit("high"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(naming.join_task_meta(events, meta))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
