"""Readers and writers over real files."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tasklens import constants as K
from tasklens.operators import registry as R
from tasklens.operators.registry import candidate_files, declared_registry, merge_registry
from tasklens.plans.catalog import canonical
from tasklens.sources import readers

TASKS = '''
from jobs import app, shared_task

@shared_task
def plain(): ...

@shared_task(queue="priority")
def queued(x: int, *rest, key, **more): ...

@app.task(bind=True)
@other(queue="second")
async def bound(self, a=1, /, b="x"): ...

def helper(): ...

class Box:
    @get_app().task
    def inner(self) -> None:
        @task
        def deep(): ...

@registry["task"]
def not_a_task(): ...

@app.tasks
def nor_this(): ...
'''


def _tree(root):
    shop = root / "src" / "shop"
    (shop / "tasks").mkdir(parents=True)
    for folder in (shop, shop / "tasks"):
        (folder / "__init__.py").write_text("")
    (shop / "tasks.py").write_text(TASKS)
    (shop / "tasks" / "emails.py").write_text("@shared_task\ndef send(): ...\n")
    (shop / "tasks" / "__init__.py").write_text("@task\ndef at_top(): ...\n")
    (shop / "tasks" / "_private.py").write_text("@task\ndef hidden(): ...\n")
    (shop / "models.py").write_text("@task\ndef elsewhere(): ...\n")
    (shop / "celery.py").write_text("def broken(:\n")
    (shop / "celery_tasks.py").write_bytes(b"\xff\xfe not text")
    loose = root / "loose"
    loose.mkdir()
    (loose / "tasks.py").write_text("@task\ndef alone(): ...\n")
    (loose / "celery.py").write_text("#" * (K.SOURCE_FILE_BYTES + 1))
    os.symlink(loose / "tasks.py", loose / "celery_tasks.py")
    return shop, loose


def test_source_scan(spark, tmp_path):
    shop, loose = _tree(tmp_path)
    roots = spark.createDataFrame([(str(shop),), (str(loose),), (str(tmp_path / "missing"),)], "root string")
    files = readers.scan_source_files(roots)
    names = {os.path.relpath(r.path, tmp_path) for r in files.select("path").collect()}
    assert names == {
        "src/shop/tasks.py", "src/shop/celery.py", "src/shop/celery_tasks.py", "src/shop/tasks/__init__.py",
        "src/shop/tasks/emails.py", "loose/tasks.py",
    }
    listing = readers.list_source_files(roots, with_content=False)
    found = {r.name: r for r in declared_registry(files, listing).collect()}
    assert set(found) == {
        "shop.tasks.plain", "shop.tasks.queued", "shop.tasks.bound", "shop.tasks.inner", "shop.tasks.deep",
        "shop.tasks.__init__.at_top", "shop.tasks.emails.send", "alone",
    }
    queued, bound = found["shop.tasks.queued"], found["shop.tasks.bound"]
    assert (queued.queue, queued.signature) == ("priority", "(x: int, *rest, key, **more)")
    assert (bound.queue, bound.signature) == ("second", "(self, a, b)")
    assert found["alone"].module is None and found["shop.tasks.plain"].module == "shop.tasks"
    assert not queued.loaded
    assert [r.name for r in merge_registry(declared_registry(files, listing)).collect()] == sorted(found)


def test_contents_are_sorted_in_partitions_by_size_alone(spark, monkeypatch):
    """Files in one partition are moved before anything sorts them; each path comes out once, whatever names it twice."""
    rows = [(f"/a{i % 300}/tasks/tasks.py", 1000, bytes(50)) for i in range(600)] + [("/a1/tasks/deep/x.py", 9, b""), (None, 9, b"")]
    files = spark.createDataFrame(rows, "path string, length long, content binary").coalesce(1)
    # Both folders of a file are roots of every third.
    roots = spark.createDataFrame([(f"/a{i}{end}",) for i in range(0, 300, 3) for end in ("", "/tasks/", "")], "root string")
    monkeypatch.setattr(R, "_PARTITION_BYTES", 1512 * 6)
    found = candidate_files(files, roots)
    assert found.columns == ["path", "length", "content"]
    assert sorted(r.path for r in found.collect()) == sorted(f"/a{i}/tasks/tasks.py" for i in range(0, 300, 3))
    text = found._jdf.queryExecution().executedPlan().toString()
    before, sort = text.rindex("REPARTITION_BY_NUM"), text.index("SortAggregate")
    assert "hashpartitioning(path" in text and "SortAggregate" not in text[before:] and sort < before
    assert found.rdd.getNumPartitions() == 100


def test_roots_and_paths_never_go_whole_to_the_driver(spark, tmp_path):
    """However small Spark takes the tables to be, neither join of the choice is a broadcast; nulls and copies change nothing."""
    rows = [(f"/a{i % 40}/tasks.py", 10) for i in range(80)] + [("/a1/tasks/mail.py", 10), ("/a2/models.py", 10), (None, 10), ("/a3/celery.py", None)]
    spark.createDataFrame(rows, "path string, length long").write.parquet(str(tmp_path / "files"))
    files = spark.read.parquet(str(tmp_path / "files"))
    roots = spark.createDataFrame([("/a1",), ("/a2/",), ("/a2",), (None,), ("/missing",)], "root string")
    for listing in (None, files):
        found = candidate_files(files, roots, listing)
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
        assert sorted(found.collect()) == [("/a1/tasks.py", 10), ("/a1/tasks/mail.py", 10), ("/a2/tasks.py", 10)]
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_json_keeps_microseconds(spark, tmp_path):
    df = spark.sql("SELECT 1L AS event_id, TIMESTAMP_NTZ '2024-01-01 00:00:07.179575' AS event_ts")
    readers.write_json(df, str(tmp_path / "j"))
    back = readers.read_task_events(spark, str(tmp_path / "j"), "json").select("event_id", "event_ts")
    assert back.collect() == df.collect()


def test_written_events_are_pruned(spark, sf, tmp_path):
    path = str(tmp_path / "events")
    events = canonical(spark, sf)
    readers.write_events(events, path)
    back = spark.read.parquet(path)
    assert back.count() == events.count()
    one = back.filter((F.col("kind") == "failed") & (F.col("event_date") == F.lit("2024-01-01").cast("date")))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(kind" in plan or "PartitionFilters: [isnotnull(event_date" in plan


def test_envelopes_as_text(spark, tmp_path):
    (tmp_path / "e.jsonl").write_text('{"type":"task-started"}\n[{"type":"a"},{"type":"b"}]\n')
    assert readers.read_envelopes(spark, str(tmp_path)).count() == 2
