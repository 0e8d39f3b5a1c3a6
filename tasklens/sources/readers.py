"""Batch and streaming reads and writes, each with an explicit schema."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasklens import constants as K
from tasklens.schemas import RAW_EVENT, SIGNAL_EVENT, SOURCE_FILE, TABLES

# Microseconds, as JSON would otherwise cut times to milliseconds.
_JSON = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def read_task_events(spark: SparkSession, path: str, fmt: str = "parquet", schema: str = RAW_EVENT) -> DataFrame:
    """Lifecycle events as rows; ``fmt`` is any file format Spark reads."""
    return spark.read.schema(schema).options(**_JSON).format(fmt).load(path)


def read_signal_events(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_task_events(spark, path, fmt, SIGNAL_EVENT)


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """Envelopes as text, one per line, for ``explode_envelopes``."""
    return spark.read.text(path).withColumnRenamed("value", "body")


def stream_task_events(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: str = RAW_EVENT, **options: object
) -> DataFrame:
    """The stream of lifecycle events arriving in a folder. Event times become instants, as watermarks need."""
    reader = spark.readStream.schema(schema).options(**_JSON).options(**{k: str(v) for k, v in options.items()})
    return reader.format(fmt).load(path)


def with_instant(df: DataFrame, time: str = "event_ts") -> DataFrame:
    return df.withColumn(time, F.col(time).cast("timestamp"))


def write_json(df: DataFrame, path: str) -> None:
    df.write.options(**_JSON).json(path)


def write_events(events: DataFrame, path: str, mode: str = "append") -> None:
    """Events as Parquet by date and kind.

    The rebalance lets AQE size the files: small (date, kind) parts are packed, large ones are split.
    """
    dated = events.withColumn("event_date", F.to_date("event_ts"))
    dated.hint("rebalance", "event_date", "kind").write.mode(mode).partitionBy("event_date", "kind").parquet(path)


def list_source_files(roots: DataFrame, with_content: bool = True) -> DataFrame:
    """The Python files directly in each folder of ``roots(root)`` or in its ``tasks`` package.

    Folders are listed where their row is, so the listing spreads over the cluster. Spark's own file sources leave
    out names that begin with an underscore, ``__init__.py`` among them. Links are not followed, and content over
    the size limit is not read.
    """

    def listing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for root in batch["root"]:
                # One small frame at a time, as file contents add up.
                rows, held = [], 0
                for path, size in _python_files(root):
                    content = _content(root, path) if with_content and size <= K.SOURCE_FILE_BYTES else None
                    rows.append((path, size, content))
                    held += size if content else 0
                    if held > _HELD_BYTES or len(rows) >= 1000:
                        yield pd.DataFrame(rows, columns=["path", "length", "content"])
                        rows, held = [], 0
                yield pd.DataFrame(rows, columns=["path", "length", "content"])

    return roots.select("root").mapInPandas(listing, SOURCE_FILE)


_HELD_BYTES = 16 * 1024 * 1024


def _filesystem(root: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(root) if ":" in root else (fs.LocalFileSystem(), root)


def _content(root: str, path: str) -> bytes:
    return _filesystem(root)[0].open_input_file(path).readall()


def _python_files(root: str) -> Iterator[tuple[str, int]]:
    from pyarrow import fs

    system, base = _filesystem(root)
    base = base.rstrip("/")

    def is_link(path: str) -> bool:
        return system.type_name == "local" and os.path.islink(path)

    if is_link(base):
        return
    for folder in (base, f"{base}/{K.SOURCE_PACKAGE}"):
        if is_link(folder):
            continue
        for info in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
            if info.is_file and info.path.endswith(".py") and not is_link(info.path):
                yield info.path, info.size


def scan_source_files(roots: DataFrame) -> DataFrame:
    """The candidate source files under ``roots(root)``, with their content."""
    from tasklens.operators.registry import candidate_files

    plain = roots.select(F.regexp_replace("root", "^file:/*", "/").alias("root"))
    return candidate_files(list_source_files(roots), plain, list_source_files(roots, with_content=False))
