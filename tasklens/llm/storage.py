"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tasklens.session import new_folder


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: packed, without lineage, and safe against lost executors."""
    folder = new_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
