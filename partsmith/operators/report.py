"""Size reports and the published-asset manifest.

Statistics are aggregates over the published tables (rows, NULL counts,
logical bytes) and, for written tables, the sizes of their files from the hidden
``_metadata`` column (only footers are read).  The manifest is a small table; entries of
the same asset are settled in one aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partsmith import schemas as S
from partsmith.functions.formatting import GB, KB, MB, pct_change


def value_bytes(df: DataFrame) -> Column:
    """Logical bytes of one row: UTF-8 length of strings, 8 per non-NULL
    number or timestamp, 1 per non-NULL boolean; NULLs are free."""
    parts = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(f.dataType, T.BooleanType):
            parts.append(F.when(c.isNotNull(), 1).otherwise(0))
        elif isinstance(f.dataType, (T.NumericType, T.TimestampType, T.TimestampNTZType,
                                     T.DateType)):
            parts.append(F.when(c.isNotNull(), 8).otherwise(0))
        else:
            parts.append(F.coalesce(F.octet_length(F.to_json(F.array(c))), F.lit(0)))
    out = parts[0].cast("bigint")
    for p in parts[1:]:
        out = out + p
    return out


def table_stats(name: str, df: DataFrame) -> DataFrame:
    """One row: table name, rows, logical bytes (a single partial aggregate)."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.coalesce(F.sum(value_bytes(df)), F.lit(0)).cast("bigint").alias("logical_bytes")) \
             .select(F.lit(name).alias("name"), "rows", "logical_bytes")


def variant_stats(products: DataFrame, columns: dict[str, Sequence[str]],
                  baseline: str | None = None) -> DataFrame:
    """``name, rows, logical_bytes`` of several variants of one table, told by the columns
    each keeps, in one scan and one aggregate (a sum per column, added up per variant); with
    ``baseline`` also ``base_bytes``, that variant's bytes on every row."""
    used = list(dict.fromkeys(c for cols in columns.values() for c in cols))
    one = products.agg(F.count(F.lit(1)).alias("rows"), *[
        F.coalesce(F.sum(value_bytes(products.select(c))), F.lit(0)).cast("bigint").alias(f"b{i}")
        for i, c in enumerate(used)])

    def total(name: str) -> Column:
        return reduce(lambda a, b: a + b, [F.col(f"b{used.index(c)}") for c in columns[name]])

    rows = F.array(*[F.struct(F.lit(n).alias("name"), F.col("rows"),
                              total(n).alias("logical_bytes")) for n in columns])
    base = [total(baseline).alias("base_bytes")] if baseline else []
    return one.select(F.explode(rows).alias("r"), *base).select("r.*", *[c for c in ["base_bytes"]
                                                                         if baseline])


def table_files(df: DataFrame) -> DataFrame:
    """One row about a table read from files: ``files, bytes, rows``."""
    per_file = df.select(F.col("_metadata.file_path").alias("path"),
                         F.col("_metadata.file_size").alias("size")).groupBy("path").agg(
        F.any_value("size").alias("size"), F.count(F.lit(1)).alias("n"))
    return per_file.agg(F.count(F.lit(1)).alias("files"),
                        F.coalesce(F.sum("size"), F.lit(0)).cast("bigint").alias("bytes"),
                        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"))


def file_bytes(spark: SparkSession, path: str) -> DataFrame:
    """Total bytes of the files under ``path`` (contents are not read)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").cast("bigint").alias("bytes"))


def _two_decimals_half_even(b: Column, unit: int) -> Column:
    """``b / unit`` rounded to 2 decimals, half to even, as text — exact on the
    integers (a double format would round ties differently per engine)."""
    num = b * 100
    q = F.floor(num / unit).cast("bigint")
    r = num - q * unit
    up = (r * 2 > unit) | ((r * 2 == unit) & (q % 2 == 1))
    cents = q + F.when(up, 1).otherwise(0)
    return F.concat((F.floor(cents / 100)).cast("bigint").cast("string"), F.lit("."),
                    F.lpad((cents % 100).cast("string"), 2, "0"))


def format_size_exact(x: Column | str) -> Column:
    """Bytes -> ``N/A`` | ``500 B`` | ``2.00 KB`` | ``10.00 MB`` | ``2.00 GB``."""
    b = (F.col(x) if isinstance(x, str) else x).cast("bigint")
    return (F.when(b.isNull(), F.lit("N/A"))
             .when(b >= GB, F.concat(_two_decimals_half_even(b, GB), F.lit(" GB")))
             .when(b >= MB, F.concat(_two_decimals_half_even(b, MB), F.lit(" MB")))
             .when(b >= KB, F.concat(_two_decimals_half_even(b, KB), F.lit(" KB")))
             .otherwise(F.concat(b.cast("string"), F.lit(" B"))))


def compare_to_baseline(stats: DataFrame, baseline: str, name_col: str = "name",
                        value_col: str = "logical_bytes") -> DataFrame:
    """Add ``pct_vs_base``: percent difference against the baseline row (0
    when the baseline is 0).  The baseline value is a scalar subquery."""
    base = stats.filter(F.col(name_col) == baseline).agg(F.max(value_col)).scalar()
    return stats.withColumn("pct_vs_base", pct_change(value_col, base))


def ranked(df: DataFrame, name_col: str, order: Sequence[str], unknown_rank: int = 999) -> DataFrame:
    """Add ``rank``: position of the name in a fixed order, unknown names last."""
    rank = F.lit(unknown_rank)
    for i, n in reversed(list(enumerate(order))):
        rank = F.when(F.col(name_col) == n, F.lit(i)).otherwise(rank)
    return df.withColumn("rank", rank)


def manifest_rows(stats: DataFrame, known: dict[str, dict[str, str]], updated_at: str,
                  name_col: str = "name", size_col: str = "logical_bytes",
                  archive_col: str | None = None) -> DataFrame:
    """Manifest entries: known assets get their fixed label/archive/description,
    others a generic description."""
    variant = F.col(name_col)
    archive = F.concat(F.col(name_col), F.lit(".tar.xz"))
    desc = F.lit("Database variant")
    for asset, meta in known.items():
        variant = F.when(F.col(name_col) == asset, F.lit(meta["variant"])).otherwise(variant)
        archive = F.when(F.col(name_col) == asset, F.lit(meta["archive_name"])).otherwise(archive)
        desc = F.when(F.col(name_col) == asset, F.lit(meta["description"])).otherwise(desc)
    return stats.select(
        F.col(name_col).alias("asset"), variant.alias("variant"), archive.alias("archive_name"),
        desc.alias("description"), F.col(size_col).cast("bigint").alias("db_size_bytes"),
        (F.col(archive_col) if archive_col else F.lit(None)).cast("bigint").alias("archive_size_bytes"),
        F.lit(updated_at).alias("last_updated"))


def merge_manifest(old: DataFrame, new: DataFrame) -> DataFrame:
    """New entries replace old ones of the same asset; other old entries stay.  A manifest is
    one row per published asset, so both are put together and each asset keeps its newest."""
    names = S.MANIFEST_SCHEMA.fieldNames()
    both = (old.select(*names, F.lit(0).alias("__age"))
            .unionByName(new.select(*names, F.lit(1).alias("__age"))))
    newest = both.groupBy("asset").agg(F.max_by(F.struct(*names[1:]), "__age").alias("__row"))
    return newest.select("asset", "__row.*")


def in_rank_order(df: DataFrame, name_col: str, order: Sequence[str]) -> DataFrame:
    """``ranked`` rows in that order; names of equal rank by name."""
    return ranked(df, name_col, order).orderBy("rank", name_col)
