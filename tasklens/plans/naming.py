"""Names, metadata and lineage."""

from __future__ import annotations

from pyspark.sql import functions as F

from tasklens.functions.names import is_placeholder, placeholder_name
from tasklens.operators import naming as N
from tasklens.plans.catalog import (
    SIGNALS_SQL,
    canonical,
    canonical_signals,
    good_events,
    joined,
    named_events,
    named_sql,
    query,
)
from tasklens.sources.views import metadata, signals, view


_CARRIED = f"WITH {named_sql()} SELECT event_id, uuid, kind, name, carried_name FROM named"


@query("carry_task_name", _CARRIED)
def carry_task_name(spark, folder):
    rows = N.carry_task_name(good_events(spark, folder))
    return rows.select("event_id", "uuid", "kind", "name", "carried_name")


@query("carry_name_of_hot_tasks", _CARRIED)
def carry_name_of_hot_tasks(spark, folder):
    """The same where a task may hold so few rows that the busier ones are cut up."""
    rows = N.carry_task_name(good_events(spark, folder), key_row_budget=6)
    return rows.select("event_id", "uuid", "kind", "name", "carried_name")


@query(
    "placeholder_name",
    """SELECT event_id, coalesce(nullif(name, ''), nullif(trim(hint), ''), '<unknown:' || nullif(queue, '') || ':' || nullif(left(task_id, 8), '') || '>',
  '<unknown:' || nullif(queue, '') || '>', '<unknown:' || nullif(left(task_id, 8), '') || '>', '<unknown>') AS task_name FROM {name_cases}""",
)
def placeholder(spark, folder):
    name = placeholder_name(F.col("name"), F.col("task_id"), F.col("queue"), F.col("hint"))
    return view(spark, folder, "name_cases").select("event_id", name.alias("task_name"))


@query(
    "is_placeholder",
    "SELECT event_id, name, name IS NULL OR name IN ('', 'unknown') OR name LIKE '<unknown%' AS is_placeholder FROM {name_cases}",
)
def placeholder_flag(spark, folder):
    return view(spark, folder, "name_cases").select(
        "event_id", "name", is_placeholder(F.col("name")).alias("is_placeholder")
    )


@query(
    "join_task_meta",
    f"""WITH {named_sql()}
SELECT event_id, n.task_name, m.tag AS tags, m.priority, m.expected_duration_ms, m.deadline_ms
FROM named n LEFT JOIN {{task_meta}} m ON n.task_name = m.task_name""",
)
def join_task_meta(spark, folder):
    rows = N.join_task_meta(named_events(spark, folder), metadata(spark, folder))
    return rows.select(
        "event_id", "task_name", joined(F.col("tags")).alias("tags"), "priority", "expected_duration_ms", "deadline_ms"
    )


@query(
    "sample_events",
    f"""WITH {named_sql()}
SELECT event_id, uuid, n.task_name FROM named n LEFT JOIN {{task_meta}} m ON n.task_name = m.task_name
WHERE NOT coalesce(m.skip, false)
  AND CAST(('0x' || substr(md5(uuid), 1, 8))::ubigint AS double) / 4294967296 < coalesce(CAST(m.sample_rate AS double), 1.0)""",
)
def sample_events(spark, folder):
    rows = N.join_task_meta(named_events(spark, folder), metadata(spark, folder))
    return N.sample_events(rows).select("event_id", "uuid", "task_name")


@query(
    "validate_meta",
    """SELECT row_id, sample_rate, priority, CASE WHEN sample_rate NOT BETWEEN 0 AND 1 THEN 'sample_rate'
  WHEN priority NOT IN ('critical', 'high', 'normal', 'low') THEN 'priority' END AS problem FROM {meta_rows}""",
)
def validate_meta(spark, folder):
    return N.validate_meta(view(spark, folder, "meta_rows"))


@query(
    "link_lineage",
    """SELECT c.task_id, c.parent_task_id, c.root_task_id, p.root_task_id AS parent_root_task_id
FROM {lineage} c LEFT JOIN {lineage} p ON c.parent_task_id = p.task_id""",
)
def link_lineage(spark, folder):
    return N.with_parent(N.link_lineage(view(spark, folder, "lineage")), ("root_task_id",))


@query(
    "signal_lineage",
    "SELECT event_id, nullif(parent_id, '') AS parent_task_id, nullif(root_id, '') AS root_task_id FROM {signal_rows} WHERE has_request",
)
def signal_lineage(spark, folder):
    rows = signals(spark, folder).filter("request is not null")
    return N.link_lineage(
        rows.select(
            "event_id", F.col("request.parent_id").alias("parent_task_id"), F.col("request.root_id").alias("root_task_id")
        )
    )


@query(
    "route_submission",
    """SELECT submission_id, name, CASE WHEN name IN (SELECT task_name FROM {task_meta}) THEN 'registered' ELSE 'by name' END AS route FROM {submissions}""",
)
def route_submission(spark, folder):
    registry = view(spark, folder, "task_meta").select(F.col("task_name").alias("name"))
    return N.route_submission(view(spark, folder, "submissions"), registry)


@query(
    "enrich_dims",
    f"""WITH {named_sql()}, {SIGNALS_SQL},
rows_ AS (SELECT 'broker:' || event_id AS event_id, event_ts, uuid AS task_id, hostname AS worker, CAST(NULL AS varchar) AS queue FROM named
  UNION ALL SELECT 'signal:' || event_id, event_ts, tid, NULL, queue FROM sig),
firsts AS (SELECT task_id AS t, min_by(worker, (event_ts, event_id)) FILTER (worker IS NOT NULL) AS w, min_by(queue, (event_ts, event_id)) FILTER (queue IS NOT NULL) AS q
  FROM rows_ WHERE task_id <> '' GROUP BY task_id)
SELECT event_id, task_id, coalesce(worker, w) AS worker, coalesce(queue, q) AS queue FROM rows_ LEFT JOIN firsts ON task_id = t""",
)
def enrich_dims(spark, folder):
    events = canonical(spark, folder).unionByName(canonical_signals(spark, folder))
    return N.enrich_dims(events).select("event_id", "task_id", "worker", "queue")
