"""Schema alignment: bring an older or partial table to a target schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def align_schema(df: DataFrame, schema: T.StructType,
                 defaults: dict[str, object] | None = None) -> DataFrame:
    """Select ``schema``'s columns in order: existing columns are cast to the
    target type, missing ones are added with their default (typed NULL when
    no default is given).  Extra columns are dropped.  Pure projection — no
    shuffle, no scan of unused columns."""
    defaults = defaults or {}
    present = set(df.columns)
    cols = []
    for f in schema.fields:
        if f.name in present:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif f.name in defaults:
            cols.append(F.lit(defaults[f.name]).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def missing_columns(df: DataFrame, schema: T.StructType) -> list[str]:
    present = set(df.columns)
    return [f.name for f in schema.fields if f.name not in present]
