"""Size-balanced work partitions for a catalog (re-aimed crawler planner).

A category whose row count reaches ``threshold`` is split by brand; a part that
is still too big (or a category without any brand) is split by keyword
character (``0-9a-z``: a row belongs to every character its text contains, so
character parts overlap); a character part that is still too big is taken as is and
flagged.  Empty parts never appear.

The parts cover every row.  Rows without a brand in a category that has brands are a part
of their own (split by character like a brand if too big), and so are the rows of a
character split whose text has none of the characters; ``rest`` names these parts.  (The
keyword queries this mirrors lose such rows; this is a deliberate deviation.)

All rows are counted once by (category, brand); what to split is told from these counts,
and one more pass over the rows to split explodes each into at most 36 (row, character)
pairs, a constant fan-out.  No level collects rows anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partsmith import schemas as S
from partsmith.functions.text import code_points
from partsmith.operators.ordering import materialize

PLAN_COLUMNS = ["category", "brand", "keyword", "rest", "row_count", "oversize"]
#: ``rest`` of the parts of rows without a brand, without a listed character, without both.
NO_BRAND, NO_CHARACTER, NEITHER = "no brand", "no character", "no brand, no character"


def _row_chars(text_col: str, chars: str) -> Column:
    allowed = F.array(*[F.lit(c) for c in chars])
    return F.array_distinct(F.filter(code_points(text_col),
                                     lambda ch: F.array_contains(allowed, ch)))


def _items(items: DataFrame, category: str, brand: str, text: str,
           known_counts: DataFrame | None) -> DataFrame:
    it = items.select(F.col(category).alias("category"), F.col(brand).alias("brand"),
                      F.col(text).alias("text"))
    if known_counts is not None:
        zero = known_counts.filter(F.col("product_num") == 0).select("category")
        it = it.join(zero, "category", "left_anti")
    return it


def _same(a: DataFrame, b: DataFrame, *names: str) -> Column:
    cond = F.lit(True)
    for n in names:
        cond = cond & a[n].eqNullSafe(b[n])
    return cond


def brand_counts(items: DataFrame, threshold: int) -> DataFrame:
    """``category, brand, row_count`` and ``how``: the (category, brand) is taken with its whole
    "category", as a "brand" part, or is to be "split"; ``lone``: rows without a brand beside
    others with one."""
    counts = items.groupBy("category", "brand").agg(F.count(F.lit(1)).alias("row_count"))
    counts = materialize(counts)  # one row per category and brand, read twice
    whole = counts.groupBy(F.col("category").alias("of")).agg(
        F.sum("row_count").alias("total"), F.count("brand").alias("brands"))
    t = F.lit(threshold)
    lone = F.col("brand").isNull() & (F.col("brands") > 0)
    how = (F.when(F.col("total") < t, "category")
           .when((F.col("row_count") < t) & (F.col("brands") > 0), "brand").otherwise("split"))
    return counts.join(whole, counts["category"].eqNullSafe(whole["of"])).select(
        "category", "brand", "row_count", "total", lone.alias("lone"), how.alias("how"))


def _characters(items: DataFrame, split: DataFrame, chars: str) -> DataFrame:
    """The rows to split, once per character that they hold (null: none)."""
    keys = split.select(F.col("category").alias("c"), F.col("brand").alias("b"), "lone")
    rows = items.join(keys, items["category"].eqNullSafe(keys["c"])
                      & items["brand"].eqNullSafe(keys["b"])).drop("c", "b")
    return rows.withColumn("keyword", F.explode_outer(_row_chars("text", chars)))


def _rest(lone: Column, character: Column) -> Column:
    return (F.when(lone & ~character, NEITHER).when(lone, NO_BRAND)
            .when(~character, NO_CHARACTER))


def partition_plan(items: DataFrame, category: str, brand: str, text: str,
                   threshold: int = S.PARTITION_THRESHOLD, chars: str = S.PARTITION_CHARS,
                   known_counts: DataFrame | None = None) -> DataFrame:
    """Work units ``(category, brand, keyword, rest, row_count, oversize)``; every row is in
    at least one.

    ``known_counts`` (``category``, ``product_num``) lets categories whose
    count is *explicitly* 0 be skipped without counting them."""
    it = _items(items, category, brand, text, known_counts)
    counts = materialize(brand_counts(it, threshold))
    no = F.lit(None).cast("string")
    wholes = counts.where("how = 'category'").select(
        "category", no.alias("brand"), no.alias("keyword"), no.alias("rest"),
        F.col("total").alias("row_count"), F.lit(False).alias("oversize")).distinct()
    brands = counts.where("how = 'brand'").select(
        "category", "brand", no.alias("keyword"), F.when(F.col("lone"), NO_BRAND).alias("rest"),
        "row_count", F.lit(False).alias("oversize"))
    # a category without brands has none under any keyword either, so an
    # oversized character part there is final (flagged)
    split = (_characters(it, counts.where("how = 'split'"), chars)
             .groupBy("category", "brand", "lone", "keyword")
             .agg(F.count(F.lit(1)).alias("row_count")).select(
                 "category", "brand", "keyword",
                 _rest(F.col("lone"), F.col("keyword").isNotNull()).alias("rest"), "row_count",
                 (F.col("row_count") >= F.lit(threshold)).alias("oversize")))
    return wholes.unionByName(brands).unionByName(split)


def assign_parts(items: DataFrame, category: str, brand: str, text: str,
                 threshold: int = S.PARTITION_THRESHOLD,
                 chars: str = S.PARTITION_CHARS) -> DataFrame:
    """``items`` with the work unit (``part_brand``, ``part_keyword``, ``part_rest``) of each
    row, once per unit that holds it."""
    names = items.columns
    it = items.select(F.struct(*names).alias("item"), F.col(category).alias("category"),
                      F.col(brand).alias("brand"), F.col(text).alias("text"))
    counts = materialize(brand_counts(it, threshold))
    keys = counts.select(F.col("category").alias("c"), F.col("brand").alias("b"), "lone", "how")
    rows = it.join(keys, it["category"].eqNullSafe(keys["c"]) & it["brand"].eqNullSafe(keys["b"]))
    split = F.col("how") == "split"
    held = F.when(split, _row_chars("text", chars))  # null: one row, as for no character
    out = rows.withColumn("part_keyword", F.explode_outer(held))
    whole = F.col("how") == "category"
    return out.select(
        "item.*", F.when(~whole, F.col("brand")).alias("part_brand"), "part_keyword",
        F.when(~whole, _rest(F.col("lone"), ~split | F.col("part_keyword").isNotNull()))
        .alias("part_rest"))


def union_dedupe(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Rows of overlapping partitions, each key once."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.dropDuplicates(keys)
