"""Second-vendor enrichment and scalar mapping queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from partsmith.functions.coerce import (
    epoch_to_timestamp,
    tier_label,
    timestamp_to_epoch,
    timestamp_to_epoch_sql,
)
from partsmith.functions.formatting import format_duration
from partsmith.operators.enrich import enrich
from partsmith.operators.ordering import spread
from partsmith.plans.bindings import t, vendor_tables
from partsmith.plans.registry import query
from partsmith.session import scratch_path
from partsmith.sources.vendor import read_vendor_rejects, read_vendor_tables

# fixed value: origin of the duration demo (2024-01-01 00:00:00 UTC)
DURATION_ORIGIN = 1704067200


# --- J1 + P9 + P10 + P11: components LEFT JOIN categories LEFT JOIN manufacturers --
@query("vendor_enrich_join", sql="""
SELECT 'C' || (l_orderkey * 10 + l_linenumber) AS sku,
       printf('MFR-%d', l_partkey) AS mfr_part_number,
       CAST(if(l_orderkey % 50 = 1, -1 - l_partkey, l_partkey) AS BIGINT) AS brand_id,
       CAST(if(l_orderkey % 32 = 0, -1 - l_suppkey, l_suppkey) AS BIGINT) AS category_id,
       p_brand || ' ' || p_name AS brand_name,
       'Cat-' || s_nationkey AS first_category_name, s_name AS second_category_name,
       l_returnflag || l_linestatus AS package,
       printf('line %d of %d', l_linenumber, l_orderkey) AS description,
       printf('https://example.com/ds/%d.pdf', l_partkey) AS pdf_url,
       CAST(l_quantity AS BIGINT) AS vendor_stock,
       '[{"qFrom":1,"cents":' || CAST(floor(l_extendedprice * 100) AS BIGINT) || '}]' AS vendor_price_ladder,
       if(l_returnflag = 'A', 'Basic', if(l_linestatus = 'O', 'Preferred', 'Extended')) AS vendor_library_type,
       if(l_linenumber % 2 = 1, printf('{"n":%d}', l_linenumber), NULL) AS vendor_extra,
       CAST(l_shipdate AS TIMESTAMP) AS vendor_last_updated
FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey AND l_orderkey % 32 <> 0
              LEFT JOIN part ON p_partkey = l_partkey AND l_orderkey % 50 <> 1""")
def vendor_enrich_join(spark, sf):
    """Vendor components joined to categories and manufacturers, mapped to catalog columns."""
    comps, cats, mfrs = vendor_tables(spread(t(spark, sf, "lineitem")), t(spark, sf, "supplier"),
                                      t(spark, sf, "part"))
    return enrich(comps, cats, mfrs)


# --- S5: the vendor tables landed as CSV exports, some lines broken -----------------
BROKEN = 40  # of the orders, one in so many has lines with text for the stock


@query("vendor_files_enrich", sql=f"""
WITH c AS (SELECT *, l_orderkey * 10 + l_linenumber AS code, l_orderkey % {BROKEN} = 0 AS broken FROM lineitem)
SELECT 'C' || code AS sku, s_name AS second_category_name, p_brand || ' ' || p_name AS brand_name,
       CAST(l_quantity AS BIGINT) AS vendor_stock,
       '[{{"qFrom":1,"cents":' || CAST(floor(l_extendedprice * 100) AS BIGINT) || '}}]' AS vendor_price_ladder,
       NULL AS rejected_from
FROM c LEFT JOIN supplier ON s_suppkey = l_suppkey AND l_orderkey % 32 <> 0
       LEFT JOIN part ON p_partkey = l_partkey AND l_orderkey % 50 <> 1
WHERE NOT broken
UNION ALL SELECT 'C' || code, NULL, NULL, NULL, NULL, 'components' FROM c WHERE broken""")
def vendor_files_enrich(spark, sf):
    """Vendor tables landed as CSV files and read with their schemas: good lines joined and
    mapped, lines that don't fit kept apart."""
    comps, cats, mfrs = vendor_tables(spread(t(spark, sf, "lineitem")), t(spark, sf, "supplier"),
                                      t(spark, sf, "part"))
    base = scratch_path(spark, "vendor")
    broken = F.floor(F.col("part_code") / 10) % BROKEN == 0
    comps = comps.withColumn("stock", F.when(broken, F.lit("n/a"))
                             .otherwise(F.col("stock").cast("string")))
    for name, rows in (("components", comps), ("categories", cats), ("manufacturers", mfrs)):
        rows.write.option("header", "true").csv(f"{base}/{name}")
    v = read_vendor_tables(spark, base, "csv")
    no = F.lit(None).cast("string")
    good = enrich(v["components"], v["categories"], v["manufacturers"]).select(
        "sku", "second_category_name", "brand_name", "vendor_stock", "vendor_price_ladder",
        no.alias("rejected_from"))
    bad = read_vendor_rejects(spark, base).select(
        F.concat(F.lit("C"), F.split("line", ",", 2)[0]).alias("sku"),
        no.alias("second_category_name"), no.alias("brand_name"),
        F.lit(None).cast("bigint").alias("vendor_stock"), no.alias("vendor_price_ladder"),
        F.col("table").alias("rejected_from"))
    return good.unionByName(bad)


# --- P10: library tier from two nullable flags ----------------------------------
@query("tier_case", sql="""
SELECT p_partkey, basic, preferred,
       CASE WHEN basic = 1 THEN 'Basic' WHEN preferred = 1 THEN 'Preferred' ELSE 'Extended' END AS tier
FROM (SELECT p_partkey,
             CASE WHEN p_size % 7 = 0 THEN NULL WHEN p_size % 3 = 0 THEN 1 ELSE 0 END AS basic,
             CASE WHEN p_size > 45 THEN NULL WHEN p_type = 'SMALL' THEN 1 ELSE 0 END AS preferred
      FROM part)""")
def tier_case(spark, sf):
    """Library tier from two nullable flags."""
    p = t(spark, sf, "part").select(
        "p_partkey",
        F.when(F.col("p_size") % 7 == 0, None).when(F.col("p_size") % 3 == 0, 1).otherwise(0)
        .alias("basic"),
        F.when(F.col("p_size") > 45, None).when(F.col("p_type") == "SMALL", 1).otherwise(0)
        .alias("preferred"))
    return p.select("p_partkey", "basic", "preferred",
                    tier_label("basic", "preferred").alias("tier"))


# --- P11: epoch seconds <-> timestamp -------------------------------------------------
@query("epoch_to_ts", sql="""
SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch_s,
       make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000) AS ts_from_epoch
FROM events""")
def epoch_to_ts(spark, sf):
    """Event timestamps to epoch seconds and back."""
    ev = t(spark, sf, "events")
    return ev.select("event_id", timestamp_to_epoch("ts").alias("epoch_s"),
                     epoch_to_timestamp(timestamp_to_epoch_sql("ts")).alias("ts_from_epoch"))


# --- P15: duration text ----------------------------------------------------------------
@query("duration_format", sql=f"""
SELECT event_id, secs,
       CASE WHEN greatest(secs, 0) >= 3600
              THEN printf('%dh %02dm %02ds', greatest(secs, 0) // 3600, (greatest(secs, 0) % 3600) // 60, greatest(secs, 0) % 60)
            WHEN greatest(secs, 0) >= 60
              THEN printf('%dm %02ds', greatest(secs, 0) // 60, greatest(secs, 0) % 60)
            ELSE printf('%ds', greatest(secs, 0)) END AS duration
FROM (SELECT event_id,
             CAST((CAST(floor(epoch(ts)) AS BIGINT) - {DURATION_ORIGIN}) // (event_id % 50 + 1) - 100 AS BIGINT) AS secs
      FROM events)""")
def duration_format(spark, sf):
    """Seconds as duration text (negative -> 0s)."""
    ev = t(spark, sf, "events")
    secs = (F.floor((timestamp_to_epoch("ts") - DURATION_ORIGIN) / (F.col("event_id") % 50 + 1))
            - 100).cast("bigint")
    return ev.select("event_id", secs.alias("secs")).select(
        "event_id", "secs", format_duration("secs").alias("duration"))
