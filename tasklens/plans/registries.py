"""Task registries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tasklens.operators import registry as R
from tasklens.plans.catalog import query
from tasklens.sources.views import view


@query("runtime_registry", "SELECT name, seq, queue, true AS loaded FROM {registry} WHERE NOT starts_with(name, 'celery.')")
def runtime_registry(spark, folder):
    return R.runtime_registry(view(spark, folder, "registry")).select("name", "seq", "queue", "loaded")


@query(
    "default_queue",
    "SELECT seq, coalesce(nullif(queue, ''), CASE WHEN seq % 5 > 1 THEN 'option' || seq % 5 END) AS queue FROM {registry}",
)
def default_queue(spark, folder):
    option = F.when(F.col("seq") % 5 == 0, F.lit("")).when(
        F.col("seq") % 5 > 1, F.concat(F.lit("option"), F.col("seq") % 5)
    )
    return view(spark, folder, "registry").select("seq", R.default_queue(F.col("queue"), option).alias("queue"))


def _sources(spark, folder):
    """The files of ``source_files`` with Python text written from their part's columns."""
    part = F.col("p_partkey")
    name = F.regexp_replace("p_name", " ", "_")
    text = F.concat(
        F.lit("from app import app\n\n@app.task(bind=True, queue='"), F.lower("p_brand"),
        F.lit("')\ndef "), name, F.lit("(self, size: int = "), F.col("p_size"), F.lit(", *rest, mode='x', **more):\n    pass\n\n\n"),
        F.lit("class Box:\n    @shared_task\n    async def inner_"), part, F.lit("(x: 'list[int]'): ...\n\n"),
        F.lit("@other.tasks\ndef helper(): ...\n"),
    )
    broken = F.when(part % 13 == 5, F.concat(text, F.lit("def broken(:\n"))).otherwise(text)
    return view(spark, folder, "source_files").withColumn("content", broken.cast("binary"))


_SCANNED = """FROM {source_files} WHERE length <= 2097152 AND file IN ('tasks.py', 'celery.py', 'tasks/__init__.py', 'tasks/mail.py') AND p_partkey % 13 <> 5"""


@query(
    "scan_definitions",
    f"""SELECT path, replace(p_name, ' ', '_') AS function, lower(p_brand) AS queue, '(self, size: int, *rest, mode, **more)' AS signature {_SCANNED}
UNION ALL SELECT path, 'inner_' || p_partkey, NULL, '(x: ''list[int]'')' {_SCANNED}""",
)
def scan_definitions(spark, folder):
    """The declarations in all files that may hold some, under the roots of all applications."""
    sources = _sources(spark, folder)
    roots = sources.select(F.regexp_extract("path", "^(.*/app[0-9]+)/", 1).alias("root")).distinct()
    files = R.candidate_files(sources, roots)
    return R.scan_definitions(files).select("path", "function", "queue", "signature")


@query(
    "module_names",
    """SELECT path, CASE WHEN file LIKE 'tasks/deep/%' THEN NULL
  WHEN file LIKE 'tasks/%' THEN CASE WHEN p_partkey % 4 = 1 THEN '' ELSE 'app' || p_partkey || '.' END || replace(replace(file, '/', '.'), '.py', '')
  WHEN p_partkey % 4 = 1 THEN NULL ELSE 'app' || p_partkey || '.' || replace(file, '.py', '') END AS module FROM {source_files}""",
)
def module_names(spark, folder):
    files = view(spark, folder, "source_files").select("path")
    return R.module_names(files, files)


@query(
    "merge_registry",
    """SELECT name, loaded, seq, queue FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY loaded DESC, seq DESC) AS r FROM {registry}
  WHERE NOT starts_with(name, 'celery.')) x WHERE r = 1 ORDER BY name""",
)
def merge_registry(spark, folder):
    rows = view(spark, folder, "registry").filter(~F.col("name").startswith("celery."))
    merged = R.merge_registry(rows.filter("loaded"), rows.filter("not loaded"))
    return merged.select("name", "loaded", "seq", "queue")


@query(
    "registry_diff",
    """SELECT coalesce(a.name, b.name) AS name, CASE WHEN b.name IS NULL THEN 'added' WHEN a.name IS NULL THEN 'removed' ELSE 'updated' END AS change, a.queue
FROM {registry_after} a FULL JOIN {registry_before} b ON a.name = b.name
WHERE a.name IS NULL OR b.name IS NULL OR a.queue IS DISTINCT FROM b.queue""",
)
def registry_diff(spark, folder):
    return R.registry_diff(view(spark, folder, "registry_before"), view(spark, folder, "registry_after"))
