"""Readers for Parquet tables and optional sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from partsmith.sources.files import exists


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """``<base>/<name>.parquet`` (file or folder) as a DataFrame."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def read_optional(spark: SparkSession, path: str | None, schema: T.StructType) -> DataFrame:
    """Read a Parquet table if it exists, else an empty DataFrame with ``schema``
    (an absent optional source is skipped, not an error).  Existence is asked of the
    file system of the path, as Spark's reader would resolve it."""
    if path and exists(spark, path):
        return spark.read.parquet(path)
    return spark.createDataFrame([], schema)
