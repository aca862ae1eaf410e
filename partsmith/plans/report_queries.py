"""Counts, ingest progress, run summary and constraint audit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from partsmith.operators.audit import audit, check, duplicate_keys, orphan_rows
from partsmith.operators.progress import progress_series, run_summary
from partsmith.plans.bindings import t
from partsmith.plans.registry import query

EXPECTED_PER_RUN = 50000  # fixed value: expected items per run in the page log
COUNTED_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                  "events"]


def _page_log(spark, sf):
    """events as a page log: run = event_type, one page per event, items = k."""
    ev = t(spark, sf, "events")
    return ev.select("event_type", "event_id", "ts", "user_id",
                     F.get_json_object("props", "$.k").cast("bigint").alias("items"))


# --- A1 ---------------------------------------------------------------------
@query("table_counts", sql=" UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in COUNTED_TABLES))
def table_counts(spark, sf):
    """Row counts of the driver tables."""
    parts = [t(spark, sf, n).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(n).alias("table_name"), "row_count") for n in COUNTED_TABLES]
    return reduce(lambda a, b: a.unionByName(b), parts)


# --- A2: distinct non-zero ids seen ----------------------------------------------
@query("distinct_seen", sql="""
SELECT count(DISTINCT nullif(user_id, 0)) AS distinct_seen, count(nullif(user_id, 0)) AS seen_items,
       count(*) AS fetched_items FROM events""")
def distinct_seen(spark, sf):
    """Distinct non-zero ids seen, items with an id, all items."""
    ev = t(spark, sf, "events")
    nz = F.nullif(F.col("user_id"), F.lit(0))
    return ev.agg(F.count_distinct(nz).alias("distinct_seen"), F.count(nz).alias("seen_items"),
                  F.count(F.lit(1)).alias("fetched_items"))


# --- A3: items fetched per query (all items, and items with a truthy id) -------------
@query("page_totals", sql="""
SELECT event_type AS query_name, count(*) AS items, count(nullif(user_id, 0)) AS truthy_items,
       CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS page_items
FROM events GROUP BY event_type""")
def page_totals(spark, sf):
    """Items and items with an id per query (event type), and their page item sum."""
    log = _page_log(spark, sf)
    return log.groupBy(F.col("event_type").alias("query_name")).agg(
        F.count(F.lit(1)).alias("items"),
        F.count(F.nullif(F.col("user_id"), F.lit(0))).alias("truthy_items"),
        F.sum("items").cast("bigint").alias("page_items"))


# --- W2: progress series ---------------------------------------------------------------
@query("ingest_progress", sql=f"""
WITH log AS (SELECT event_type, event_id, ts, user_id,
                    CAST(json_extract_string(props, '$.k') AS BIGINT) AS items FROM events),
s AS (SELECT *, CAST(sum(items) OVER (PARTITION BY event_type ORDER BY ts, event_id
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS fetched,
             min(ts) OVER (PARTITION BY event_type) AS first_ts FROM log),
e AS (SELECT *, CAST(epoch_us(ts) - epoch_us(first_ts) AS DOUBLE) / CAST(1000000 AS DOUBLE) AS elapsed_s FROM s),
r AS (SELECT *, CASE WHEN elapsed_s > 0 THEN CAST(fetched AS DOUBLE) / elapsed_s ELSE CAST(0 AS DOUBLE) END AS rate,
             greatest(CAST({EXPECTED_PER_RUN} AS BIGINT) - fetched, CAST(0 AS BIGINT)) AS remaining FROM e),
f AS (SELECT *, CASE WHEN rate > 0 THEN CAST(floor(remaining / rate) AS BIGINT) END AS eta_s FROM r)
SELECT event_type, event_id, ts, items, fetched, elapsed_s, rate,
       CAST(fetched AS DOUBLE) * CAST(100 AS DOUBLE) / CAST({EXPECTED_PER_RUN} AS DOUBLE) AS pct,
       remaining, eta_s,
       CASE WHEN eta_s IS NULL THEN 'N/A'
            WHEN greatest(eta_s, 0) >= 3600 THEN printf('%dh %02dm %02ds', eta_s // 3600, (eta_s % 3600) // 60, eta_s % 60)
            WHEN greatest(eta_s, 0) >= 60 THEN printf('%dm %02ds', eta_s // 60, eta_s % 60)
            ELSE printf('%ds', greatest(eta_s, 0)) END AS eta
FROM f""")
def ingest_progress(spark, sf):
    """Per page of each run: running total, percent of expected, rate, remaining, ETA."""
    log = _page_log(spark, sf)
    out = progress_series(log, "event_type", "ts", ["ts", "event_id"], "items",
                          EXPECTED_PER_RUN)
    return out.select("event_type", "event_id", "ts", "items", "fetched", "elapsed_s", "rate",
                      "pct", "remaining", "eta_s", "eta")


# --- W4: run summary ------------------------------------------------------------------------
@query("run_summary", sql=f"""
WITH log AS (SELECT event_type, ts, user_id,
                    CAST(json_extract_string(props, '$.k') AS BIGINT) AS items FROM events),
a AS (SELECT event_type, (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000000 AS secs,
             CAST(sum(items) AS BIGINT) AS fetched, count(DISTINCT nullif(user_id, 0)) AS unique_products
      FROM log GROUP BY event_type)
SELECT event_type,
       CASE WHEN secs >= 3600 THEN printf('%dh %02dm %02ds', secs // 3600, (secs % 3600) // 60, secs % 60)
            WHEN secs >= 60 THEN printf('%dm %02ds', secs // 60, secs % 60)
            ELSE printf('%ds', secs) END AS duration,
       CAST({EXPECTED_PER_RUN} AS BIGINT) AS expected, fetched,
       CAST(fetched AS DOUBLE) * CAST(100 AS DOUBLE) / CAST({EXPECTED_PER_RUN} AS DOUBLE) AS pct,
       unique_products
FROM a""")
def run_summary_q(spark, sf):
    """Per run: duration, expected, fetched, percent, distinct products."""
    return run_summary(_page_log(spark, sf), "event_type", "ts", "items", "user_id",
                       EXPECTED_PER_RUN)


# --- J4: declared keys audited -------------------------------------------------------------
@query("constraint_audit", sql="""
SELECT 'orders.o_custkey->customer' AS "check",
       count(*) FILTER (WHERE o_custkey IS NOT NULL AND if(o_orderkey % 20 = 0, -o_custkey, o_custkey)
                        NOT IN (SELECT c_custkey FROM customer)) AS violations FROM orders
UNION ALL
SELECT 'lineitem.l_orderkey->orders', count(*) FILTER (WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)) FROM lineitem
UNION ALL
SELECT 'lineitem.l_partkey->part', count(*) FILTER (WHERE if(l_orderkey % 30 = 0, -l_partkey, l_partkey)
                                                             NOT IN (SELECT p_partkey FROM part)) FROM lineitem
UNION ALL
SELECT 'customer.c_custkey unique', count(*) FROM (SELECT c_custkey FROM customer GROUP BY 1 HAVING count(*) > 1)
UNION ALL
SELECT 'events.user_id unique', count(*) FROM (SELECT user_id FROM events GROUP BY 1 HAVING count(*) > 1)
UNION ALL
SELECT 'orders.o_custkey not null', count(*) FILTER (WHERE o_custkey IS NULL) FROM orders""")
def constraint_audit(spark, sf):
    """Orphaned foreign keys, duplicate keys and NULL keys across the driver tables (some
    references are made to point nowhere)."""
    orders, lineitem = t(spark, sf, "orders"), t(spark, sf, "lineitem")
    customer, part = t(spark, sf, "customer"), t(spark, sf, "part")
    orders = orders.withColumn("o_custkey", F.when(F.col("o_orderkey") % 20 == 0, -F.col("o_custkey"))
                               .otherwise(F.col("o_custkey")))
    lineitem = lineitem.withColumn("l_partkey", F.when(F.col("l_orderkey") % 30 == 0,
                                                       -F.col("l_partkey")).otherwise(F.col("l_partkey")))
    return audit([
        check("orders.o_custkey->customer", orphan_rows(orders, "o_custkey", customer, "c_custkey")),
        check("lineitem.l_orderkey->orders", orphan_rows(lineitem, "l_orderkey", orders, "o_orderkey")),
        check("lineitem.l_partkey->part", orphan_rows(lineitem, "l_partkey", part, "p_partkey")),
        check("customer.c_custkey unique", duplicate_keys(t(spark, sf, "customer"), ["c_custkey"])),
        check("events.user_id unique", duplicate_keys(t(spark, sf, "events"), ["user_id"])),
        check("orders.o_custkey not null", orders.filter(F.col("o_custkey").isNull())),
    ])
