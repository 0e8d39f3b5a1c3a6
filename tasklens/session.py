"""Session set-up, shared working folders and size checks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join whose output feeds an aggregate on the same key may still split its hot partitions.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM leaves methods over 8000 bytes uncompiled. Wide mappings exceed that as one whole-stage method, and
    # run several times faster as a chain of small ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Ranks that are cut at the hard cap of a command are cut before the shuffle too.
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoint files go when the tables made of them are gone.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app_name: str = "tasklens", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings the operators are planned for; ``conf`` uses ``_`` keys or a dict."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**_DEFAULTS, **conf}.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def working_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own: on a cluster a machine-local
    folder would be lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="tasklens-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{working_dir(spark).rstrip('/')}/tasklens/{purpose}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder: fixed rows, no lineage, safe against lost executors."""
    spark = df.sparkSession
    folder = working_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once as a table in the shared folder, and read from there: computed once, fixed, without lineage."""
    folder = new_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
