"""Helpers shared by the operators: word columns, row keys, written tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partsmith.session import scratch_path

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Runs of ASCII characters that are neither digits nor lower-case letters.
WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A table below both bounds is broadcast, a larger one is joined by shuffle.
BROADCAST_ROWS = 300_000
BROADCAST_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only.  Pure ASCII text takes the fast built-in path."""
    return (F.when(F.octet_length(text) == F.char_length(text), F.lower(text))
            .otherwise(F.translate(text, _UPPER, _UPPER.lower())))


def words(text: Column) -> Column:
    """Words of a text as an array; null and empty texts have none."""
    parts = F.split(lower_ascii(F.coalesce(text, F.lit(""))), WORD_GAP)
    return F.array_remove(parts, "")


def text_key(doc_id: Column, text: Column) -> list[Column]:
    """Columns that identify a document row: its id and a hash of its text.  Rows
    equal in both are the same document and get the same result."""
    return [doc_id.alias("doc_id"), F.xxhash64(text).alias("text_hash")]


def on_key(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality of ``keys``."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder in the shared checkpoint directory and read
    it back: lineage ends there, and lost executors recompute nothing before it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_enough(df: DataFrame, size: Column, rows: int = BROADCAST_ROWS,
                 max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a written table is below the broadcast bounds; ``size`` estimates
    the bytes of one row."""
    n, b = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size.cast("long")), F.lit(0))).first()
    return n <= rows and b <= max_bytes
