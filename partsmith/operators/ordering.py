"""Global ordering helpers that stay distributed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partsmith.session import checkpoint_dir
from partsmith.sources.files import file_size

_LOW_BITS = 33  # monotonically_increasing_id(): partition id << 33 | row number


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared ``spark.checkpoint.dir``: cuts the
    lineage and pins the data, so later reads see exactly the same rows even
    if executors are lost (recomputation would not be needed)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def global_index(df: DataFrame, order: Sequence[Column | str], name: str = "idx") -> DataFrame:
    """Add a dense 1-based position in ``order`` (which must be unique), without
    funnelling the rows through one task.

    The rows are range-partitioned and sorted (a distributed sort), tagged with
    ``monotonically_increasing_id`` (partition id in the high bits, position in
    the low bits), and pinned with a checkpoint.  Per-partition row counts —
    one row per partition, a proven small bound — give each partition's
    offset, which is broadcast back."""
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    tagged = materialize(df.orderBy(*cols).withColumn("__mid", F.monotonically_increasing_id()))
    part = F.shiftright(F.col("__mid"), _LOW_BITS)
    local = F.col("__mid").bitwiseAND(F.lit((1 << _LOW_BITS) - 1))
    counts = tagged.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select(
        "__part",
        (F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("__off"))
    out = (tagged.withColumn("__part", part).withColumn("__local", local)
           .join(F.broadcast(offsets), "__part", "left"))
    return out.select(*[c for c in df.columns],
                      (F.coalesce(F.col("__off"), F.lit(0)) + F.col("__local") + 1)
                      .cast("bigint").alias(name))


def spread(df: DataFrame) -> DataFrame:
    """Give CPU-heavy per-row work over a plain file scan at least one task per core.

    The number of splits is told from the sizes of the scanned files, so nothing runs; a
    large input is returned as is, one of fewer splits than the cluster has cores
    is spread round-robin (a shuffle of a small input).  Only for scans: other inputs have
    the partitions of their last shuffle."""
    spark = df.sparkSession
    target = spark.sparkContext.defaultParallelism
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    splits = sum(max(1, -(-file_size(spark, f) // split)) for f in df.inputFiles()[:target])
    return df if splits >= target else df.repartition(target)
