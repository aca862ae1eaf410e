"""Ingest progress over a page log: running totals, percentage, rate, ETA,
and a per-run summary.

A page log has a run id, an order (e.g. ``ts``, ``id``) and an item count per
page.  The running total is a segmented prefix scan, so that no run, however
large or short in time, is funnelled into one task: pages are dealt by ranges of (run,
order) whose borders are sampled from the rows, the totals of the segments (a run within
a range) are prefix-summed per run (one row per segment), and the running total inside
each segment is added to the sum carried over from the segments before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partsmith.functions.formatting import format_duration
from partsmith.operators.ordering import materialize


def _segments(df: DataFrame, partition: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` with ``__chunk``, the number of the range of (partition, order) a row is in.  The
    rows are pinned (the borders are sampled), so both reads see the same ranges."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(df.repartitionByRange(n, *partition, *order)
                       .withColumn("__chunk", F.spark_partition_id()))


def running_sum(df: DataFrame, partition: Sequence[str], order: Sequence[str], value: str,
                chunk: Column | None = None, name: str = "running") -> DataFrame:
    """``sum(value) over (partition by .. order by .. rows unbounded preceding)``
    computed segment-wise.  ``order`` must be unique within a partition.  A given ``chunk``
    names the segments instead of sampled ranges; it must be non-decreasing in ``order``."""
    part = list(partition)
    d = _segments(df, part, order) if chunk is None else df.withColumn("__chunk", chunk)
    totals = d.groupBy(*part, "__chunk").agg(F.sum(value).alias("__chunk_sum"))
    w_chunks = (Window.partitionBy(*part).orderBy("__chunk")
                .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(*[F.col(c).alias(f"__{c}") for c in part],
                            F.col("__chunk").alias("__of"),
                            F.coalesce(F.sum("__chunk_sum").over(w_chunks), F.lit(0))
                            .alias("__offset"))
    w_in = (Window.partitionBy(*part, "__chunk").orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, 0))
    local = d.withColumn("__local", F.sum(value).over(w_in))
    same = F.col("__chunk") == F.col("__of")
    for c in part:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return (local.join(offsets, same)
            .withColumn(name, (F.col("__offset") + F.coalesce("__local", F.lit(0))).cast("bigint"))
            .drop("__chunk", "__of", "__offset", "__local", *[f"__{c}" for c in part]))


def _micros(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_micros(c.cast("timestamp"))


def progress_series(log: DataFrame, run: str, ts: str, order: Sequence[str], items: str,
                    expected: int, chunk: Column | None = None) -> DataFrame:
    """Per page: running fetched total, % of expected, items/s since the run's
    first page, remaining items and ETA (seconds and text; ``N/A`` at rate 0)."""
    withrun = running_sum(log, [run], order, items, chunk, "fetched")
    first = log.groupBy(run).agg(F.min(ts).alias("__first"))
    d = withrun.join(first, run, "inner")
    elapsed = ((_micros(ts) - _micros("__first")).cast("double") / F.lit(1e6))
    fetched = F.col("fetched").cast("double")
    exp = F.lit(float(expected))
    rate = F.when(F.col("elapsed_s") > 0, fetched / F.col("elapsed_s")).otherwise(F.lit(0.0))
    remaining = F.greatest(F.lit(expected).cast("bigint") - F.col("fetched"), F.lit(0).cast("bigint"))
    out = (d.withColumn("elapsed_s", elapsed)
           .withColumn("rate", rate)
           .withColumn("pct", fetched * F.lit(100.0) / exp if expected > 0 else F.lit(None).cast("double"))
           .withColumn("remaining", remaining)
           .withColumn("eta_s", F.when(F.col("rate") > 0,
                                       F.floor(F.col("remaining") / F.col("rate")).cast("bigint"))))
    return out.withColumn("eta", F.when(F.col("eta_s").isNull(), F.lit("N/A"))
                          .otherwise(format_duration("eta_s"))).drop("__first")


def run_totals(log: DataFrame, run: str, ts: str, items: str, expected: int) -> DataFrame:
    """One row per run: duration text, expected, fetched and % (NULL when nothing was
    expected)."""
    return _totals(log.groupBy(run).agg(*_totals_of(ts, items)), run, expected)


def run_summary(log: DataFrame, run: str, ts: str, items: str, product: str,
                expected: int) -> DataFrame:
    """``run_totals`` and the distinct non-zero products seen."""
    agg = log.groupBy(run).agg(
        *_totals_of(ts, items),
        F.count_distinct(F.nullif(F.col(product), F.lit(0))).alias("unique_products"))
    return _totals(agg, run, expected, "unique_products")


def _totals_of(ts: str, items: str) -> list[Column]:
    return [((_micros(F.max(ts)) - _micros(F.min(ts))) / F.lit(1e6)).alias("duration_s"),
            F.sum(items).cast("bigint").alias("fetched")]


def _totals(agg: DataFrame, run: str, expected: int, *more: str) -> DataFrame:
    return agg.select(
        run, format_duration("duration_s").alias("duration"),
        F.lit(expected).cast("bigint").alias("expected"), "fetched",
        (F.col("fetched").cast("double") * F.lit(100.0) / F.lit(float(expected))).alias("pct")
        if expected > 0 else F.lit(None).cast("double").alias("pct"), *more)
