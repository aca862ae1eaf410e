"""Partition planner (Q1) and overlapping-partition union (O1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from partsmith.operators.planner import assign_parts, partition_plan, union_dedupe
from partsmith.plans.bindings import t
from partsmith.plans.registry import query

PLAN_THRESHOLD = 60  # fixed value: small threshold so every level occurs on the test data

_ITEMS_SQL = """items AS (
  SELECT c_custkey, CAST(n_regionkey AS BIGINT) AS category,
         CASE WHEN n_regionkey = 4 OR c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END AS brand,
         CASE WHEN c_custkey % 9 = 0 THEN '#--#' ELSE lower(c_name) END AS txt
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


_PARTS_SQL = f"""{_ITEMS_SQL},
rc AS (SELECT DISTINCT c_custkey, ch FROM
       (SELECT c_custkey, unnest(regexp_extract_all(txt, '.')) AS ch FROM items)
       WHERE regexp_matches(ch, '^[0-9a-z]$')),
n AS (SELECT *, count(*) OVER (PARTITION BY category) AS total,
             count(brand) OVER (PARTITION BY category) > 0 AS branded,
             count(*) OVER (PARTITION BY category, brand) AS own FROM items),
h AS (SELECT *, CASE WHEN total < {PLAN_THRESHOLD} THEN 'category'
                     WHEN own < {PLAN_THRESHOLD} AND branded THEN 'brand' ELSE 'split' END AS how,
             brand IS NULL AND branded AS lone FROM n),
parts AS (
  SELECT h.c_custkey, category, CASE WHEN how <> 'category' THEN brand END AS brand,
         CASE WHEN how = 'split' THEN ch END AS keyword,
         CASE WHEN how = 'category' THEN NULL
              WHEN how = 'split' AND ch IS NULL THEN if(lone, 'no brand, no character', 'no character')
              WHEN lone THEN 'no brand' END AS rest, how
  FROM h LEFT JOIN rc ON h.c_custkey = rc.c_custkey AND how = 'split')"""


def _items(spark, sf):
    """Customers with region as category and segment as brand: one region has no brands, some
    customers elsewhere have none, some names have no listed character."""
    cust, nation = t(spark, sf, "customer"), t(spark, sf, "nation")
    k = F.col("c_custkey")
    return cust.join(nation, cust.c_nationkey == nation.n_nationkey).select(
        "c_custkey", F.col("n_regionkey").cast("bigint").alias("category"),
        F.when((F.col("n_regionkey") == 4) | (k % 4 == 0), None)
        .otherwise(F.col("c_mktsegment")).alias("brand"),
        F.when(k % 9 == 0, F.lit("#--#")).otherwise(F.col("c_name")).alias("name"))


@query("partition_plan", sql=f"""
WITH {_PARTS_SQL}
SELECT category, brand, keyword, rest, count(*) AS row_count,
       how = 'split' AND count(*) >= {PLAN_THRESHOLD} AS oversize
FROM parts GROUP BY category, brand, keyword, rest, how""")
def partition_plan_q(spark, sf):
    """Work units over customers: region -> segment -> name characters, threshold 60; rows
    without a segment or a character are parts too."""
    return partition_plan(_items(spark, sf), "category", "brand", "name", threshold=PLAN_THRESHOLD)


@query("partition_cover", sql=f"""
WITH {_PARTS_SQL}
SELECT category, count(DISTINCT c_custkey) AS rows_covered,
       (SELECT count(*) FROM items i WHERE i.category = p.category) AS rows_total,
       count(*) AS row_parts
FROM parts p GROUP BY category""")
def partition_cover(spark, sf):
    """Rows of each category that are in a work unit, of all its rows, and how many units
    they are in altogether."""
    items = _items(spark, sf)
    parts = assign_parts(items, "category", "brand", "name", threshold=PLAN_THRESHOLD)
    covered = parts.groupBy("category").agg(F.count_distinct("c_custkey").alias("rows_covered"),
                                            F.count(F.lit(1)).alias("row_parts"))
    total = items.groupBy("category").agg(F.count(F.lit(1)).alias("rows_total"))
    return total.join(covered, "category").select("category", "rows_covered", "rows_total",
                                                  "row_parts")


@query("partition_union_dedupe", sql="""
SELECT p_partkey, p_name, p_brand FROM part
WHERE p_brand = 'Brand#1' OR contains(lower(p_name), 'a') OR p_size < 10""")
def partition_union_dedupe(spark, sf):
    """Three overlapping part filters unioned, each key once."""
    part = t(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    parts = [part.filter(F.col("p_brand") == "Brand#1"),
             part.filter(F.lower("p_name").contains("a")),
             part.filter(F.col("p_size") < 10)]
    return union_dedupe(parts, ["p_partkey"]).select("p_partkey", "p_name", "p_brand")
