"""Declared-but-unenforced constraints, audited: orphaned foreign keys,
duplicate primary keys, NULL keys.  Each check is one anti join or one
partially aggregated group-by, so the audit scales with the tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphan_rows(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent."""
    keys = parent.select(F.col(pk).alias(fk)).distinct()
    return child.filter(F.col(fk).isNotNull()).join(keys, fk, "left_anti")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their multiplicity."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
            .filter(F.col("occurrences") > 1))


def check(name: str, violations: DataFrame, count_col: str | None = None) -> DataFrame:
    """One report row ``(check, violations)``."""
    agg = F.count(F.lit(1)) if count_col is None else F.sum(count_col)
    return violations.agg(F.coalesce(agg, F.lit(0)).cast("bigint").alias("violations")) \
                     .select(F.lit(name).alias("check"), "violations")


def audit(checks: Sequence[DataFrame]) -> DataFrame:
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out
