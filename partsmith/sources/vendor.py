"""Second vendor's bulk tables (components, categories, manufacturers).

Read with explicit schemas from Parquet or CSV exports; nothing is inferred.  Lines of a
CSV export that don't fit the schema (a column too few or too many, text in a number column)
aren't lost: the reader keeps them apart and ``read_vendor_rejects`` returns them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partsmith import schemas as S

TABLES = {
    "components": S.VENDOR_COMPONENT_SCHEMA,
    "categories": S.VENDOR_CATEGORY_SCHEMA,
    "manufacturers": S.VENDOR_MANUFACTURER_SCHEMA,
}
_CORRUPT = "__corrupt"


def _csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Lines of a CSV export (``__line``) and their parsed columns in a struct ``row``, with the
    text of a line that doesn't fit under ``_CORRUPT``.  Every line is parsed as a whole,
    whatever columns a query asks for, so it is judged the same in every query.  The first
    line of a file names the columns in the schema's order."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    lines = spark.read.text(path).where(
        (F.col("value") != ",".join(schema.fieldNames())) & (F.trim("value") != ""))
    row = F.from_csv("value", f"{fields}, `{_CORRUPT}` string",
                     {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    return lines.select(F.col("value").alias("__line"), row.alias("row"))


def read_vendor_rejects(spark: SparkSession, base: str) -> DataFrame:
    """``table, line`` of all lines of the CSV exports that don't fit their schema."""
    parts = [_csv(spark, f"{base.rstrip('/')}/{name}", schema)
             .where(F.col(f"row.{_CORRUPT}").isNotNull())
             .select(F.lit(name).alias("table"), F.col("__line").alias("line"))
             for name, schema in TABLES.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def read_vendor_tables(spark: SparkSession, base: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """The three tables from ``base/<name>`` (Parquet or CSV with a header)."""
    out = {}
    for name, schema in TABLES.items():
        path = f"{base.rstrip('/')}/{name}"
        if fmt == "csv":
            rows = _csv(spark, path, schema).where(F.col(f"row.{_CORRUPT}").isNull())
            out[name] = rows.select(*[F.col(f"row.{c}").alias(c) for c in schema.fieldNames()])
        else:
            out[name] = spark.read.schema(schema).parquet(path)
    return out
