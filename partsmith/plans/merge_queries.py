"""Merge (upsert) queries: last-write-wins dedupe, product upsert with the raw
document kept or preserved, category upserts (all columns / one column),
vendor overlay with per-column precedence, child-row refresh, mark-unseen and
the merge's affected-row counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from partsmith import schemas as S
from partsmith.operators.ingest import (
    accepted_keys,
    catalog_rows,
    params_rows,
    records_from_documents,
)
from partsmith.operators import policies
from partsmith.operators.ordering import materialize
from partsmith.operators.merge import (
    ACTION,
    Rule,
    dedupe_last_wins,
    mark_unseen,
    merge,
    merge_partial,
    merge_stats,
    refresh_children,
    stale_predicate,
)
from partsmith.plans.bindings import (
    CATEGORIES_SQL,
    CUSTOMER_PRODUCTS_SQL,
    EVENT_RECORDS_SQL,
    RUN_TS,
    VENDOR_ROWS_SQL,
    categories_from_tables,
    event_documents,
    products_from_customer,
    t,
    vendor_rows_from_events,
)
from partsmith.plans.registry import query
from partsmith.session import run_marker

# fixed values: batch boundaries of the child-row refresh
BATCH1_TS = "2024-01-11 00:00:00"
BATCH2_TS = "2024-01-21 00:00:00"

ORDER = ["ts", "event_id"]


def run_ts():
    return F.lit(RUN_TS).cast("timestamp_ntz")


def product_rules(include_raw_json: bool = True):
    return policies.product_rules(run_ts(), include_raw_json)


def overlay_rules():
    return policies.overlay_rules(run_ts())


def _target(spark, sf):
    return products_from_customer(t(spark, sf, "customer"))


def _batch(spark, sf, include_raw_json=True):
    recs = records_from_documents(event_documents(t(spark, sf, "events")), include_raw_json)
    return catalog_rows(recs, keep=ORDER)


def _merged(spark, sf, include_raw_json=True, with_action=False):
    return merge(_target(spark, sf), _batch(spark, sf, include_raw_json), [S.PRODUCT_KEY],
                 product_rules(include_raw_json), order_by=ORDER, with_action=with_action)


# --- W1 ------------------------------------------------------------------------
@query("dedupe_last_wins", sql="""
SELECT user_id, event_id, ts, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1""")
def dedupe_last_wins_q(spark, sf):
    """Latest event per user (last write wins in (ts, event_id) order)."""
    ev = t(spark, sf, "events")
    return dedupe_last_wins(ev.select("user_id", "event_id", "ts", "event_type", "value", "props"),
                            ["user_id"], ORDER)


_SRC_SQL = f"""src AS (SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY sku ORDER BY ts DESC, event_id DESC) AS rn
    FROM ({EVENT_RECORDS_SQL}) WHERE NOT rejected) WHERE rn = 1)"""


# --- U2: product upsert, raw document collected ----------------------------------
@query("merge_products", sql=f"""
WITH tgt AS ({CUSTOMER_PRODUCTS_SQL}), {_SRC_SQL}
SELECT coalesce(t.sku, s.sku) AS sku,
  CASE WHEN s.sku IS NULL THEN t.mfr_part_number ELSE s.mfr_part_number END AS mfr_part_number,
  CASE WHEN s.sku IS NULL THEN t.brand_name ELSE s.brand_name END AS brand_name,
  CASE WHEN s.sku IS NULL THEN t.description ELSE s.description END AS description,
  CASE WHEN s.sku IS NULL THEN t.category_id ELSE s.category_id END AS category_id,
  CASE WHEN s.sku IS NULL THEN t.stock ELSE s.stock END AS stock,
  CASE WHEN s.sku IS NULL THEN NULL ELSE s.moq END AS moq,
  CASE WHEN s.sku IS NULL THEN t.vendor_stock ELSE 0 END AS vendor_stock,
  CASE WHEN s.sku IS NULL THEN t.vendor_library_type END AS vendor_library_type,
  CASE WHEN s.sku IS NULL THEN t.last_updated ELSE TIMESTAMP '{RUN_TS}' END AS last_updated,
  CASE WHEN s.sku IS NULL THEN t.raw_json ELSE s.doc END AS raw_json
FROM tgt t FULL OUTER JOIN src s ON t.sku = s.sku""")
def merge_products(spark, sf):
    """Event documents upserted into ``customer`` as products: every column overwritten,
    run timestamp set, raw document collected."""
    return _merged(spark, sf).select(
        "sku", "mfr_part_number", "brand_name", "description", "category_id", "stock", "moq",
        "vendor_stock", "vendor_library_type", "last_updated", "raw_json")


# --- U2 with the raw document not collected: it is preserved ---------------------
@query("merge_preserve_column", sql=f"""
WITH tgt AS ({CUSTOMER_PRODUCTS_SQL}), {_SRC_SQL}
SELECT coalesce(t.sku, s.sku) AS sku,
  CASE WHEN s.sku IS NULL THEN t.stock ELSE s.stock END AS stock,
  CASE WHEN s.sku IS NULL THEN t.last_updated ELSE TIMESTAMP '{RUN_TS}' END AS last_updated,
  t.raw_json AS raw_json
FROM tgt t FULL OUTER JOIN src s ON t.sku = s.sku""")
def merge_preserve_column(spark, sf):
    """The same upsert without collecting raw documents: existing raw documents are
    preserved."""
    return _merged(spark, sf, include_raw_json=False).select(
        "sku", "stock", "last_updated", "raw_json")


# --- U1: category upsert, all columns overwritten -----------------------------------
@query("merge_overwrite", sql=f"""
WITH tgt AS ({CATEGORIES_SQL}),
src AS (SELECT CAST(1000 + s_suppkey * 20 AS BIGINT) AS id, CAST(100 + s_nationkey AS BIGINT) AS parent_id,
               s_name AS name_en, CAST(NULL AS VARCHAR) AS name_cn, 'S' || s_suppkey AS code FROM supplier)
SELECT coalesce(t.id, s.id) AS id,
  CASE WHEN s.id IS NULL THEN t.parent_id ELSE s.parent_id END AS parent_id,
  CASE WHEN s.id IS NULL THEN t.name_en ELSE s.name_en END AS name_en,
  CASE WHEN s.id IS NULL THEN t.name_cn ELSE s.name_cn END AS name_cn,
  CASE WHEN s.id IS NULL THEN t.code ELSE s.code END AS code
FROM tgt t FULL OUTER JOIN src s ON t.id = s.id""")
def merge_overwrite(spark, sf):
    """Category upsert by id from ``supplier`` rows, every column overwritten."""
    cats = categories_from_tables(t(spark, sf, "region"), t(spark, sf, "nation"),
                                  t(spark, sf, "customer"))
    sup = t(spark, sf, "supplier")
    src = sup.select((F.col("s_suppkey") * 20 + 1000).alias("id"),
                     (F.col("s_nationkey") + 100).cast("bigint").alias("parent_id"),
                     F.col("s_name").alias("name_en"), F.lit(None).cast("string").alias("name_cn"),
                     F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("code"))
    return merge(cats, src, ["id"], source_is_unique=True).select("id", "parent_id", "name_en", "name_cn", "code")


# --- U3: category upsert of one column ------------------------------------------------
@query("merge_partial", sql=f"""
WITH tgt AS ({CATEGORIES_SQL}),
src AS (SELECT CAST(1000 + s_suppkey * 20 AS BIGINT) AS id, s_name AS name_en FROM supplier)
SELECT coalesce(t.id, s.id) AS id, t.parent_id AS parent_id,
  CASE WHEN s.id IS NULL THEN t.name_en ELSE s.name_en END AS name_en,
  t.name_cn AS name_cn, t.code AS code
FROM tgt t FULL OUTER JOIN src s ON t.id = s.id""")
def merge_partial_q(spark, sf):
    """Category upsert of the name only; new categories get NULL elsewhere."""
    cats = categories_from_tables(t(spark, sf, "region"), t(spark, sf, "nation"),
                                  t(spark, sf, "customer"))
    src = t(spark, sf, "supplier").select((F.col("s_suppkey") * 20 + 1000).alias("id"),
                                          F.col("s_name").alias("name_en"))
    return merge_partial(cats, src, ["id"], ["name_en"], source_is_unique=True).select(
        "id", "parent_id", "name_en", "name_cn", "code")


# --- U4 + P13: second-vendor overlay ----------------------------------------------------
@query("merge_overlay_coalesce", sql=f"""
WITH tgt AS ({CUSTOMER_PRODUCTS_SQL}),
src AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sku ORDER BY ts DESC, event_id DESC) AS rn
                       FROM ({VENDOR_ROWS_SQL})) WHERE rn = 1)
SELECT coalesce(t.sku, s.sku) AS sku,
  CASE WHEN s.sku IS NULL THEN t.mfr_part_number ELSE s.mfr_part_number END AS mfr_part_number,
  CASE WHEN s.sku IS NULL THEN t.brand_name WHEN t.sku IS NULL THEN s.brand_name
       ELSE coalesce(t.brand_name, s.brand_name) END AS brand_name,
  CASE WHEN s.sku IS NULL THEN t.description WHEN t.sku IS NULL THEN s.description
       ELSE coalesce(t.description, s.description) END AS description,
  CASE WHEN s.sku IS NULL THEN t.category_id WHEN t.sku IS NULL THEN s.category_id
       ELSE coalesce(t.category_id, s.category_id) END AS category_id,
  CASE WHEN s.sku IS NULL THEN t.pdf_url WHEN t.sku IS NULL THEN s.pdf_url
       ELSE coalesce(t.pdf_url, s.pdf_url) END AS pdf_url,
  t.stock AS stock,
  CASE WHEN s.sku IS NULL THEN t.vendor_stock ELSE s.vendor_stock END AS vendor_stock,
  CASE WHEN s.sku IS NULL THEN t.vendor_library_type ELSE s.vendor_library_type END AS vendor_library_type,
  CASE WHEN s.sku IS NULL THEN t.vendor_last_updated ELSE s.vendor_last_updated END AS vendor_last_updated,
  CASE WHEN t.sku IS NULL THEN TIMESTAMP '{RUN_TS}' ELSE t.last_updated END AS last_updated
FROM tgt t FULL OUTER JOIN src s ON t.sku = s.sku""")
def merge_overlay_coalesce(spark, sf):
    """Second-vendor overlay onto ``customer`` as products with per-column precedence."""
    src = vendor_rows_from_events(t(spark, sf, "events"))
    out = merge(_target(spark, sf), src, [S.PRODUCT_KEY], overlay_rules(),
                default=Rule("keep", "source"), order_by=ORDER)
    return out.select("sku", "mfr_part_number", "brand_name", "description", "category_id",
                      "pdf_url", "stock", "vendor_stock", "vendor_library_type",
                      "vendor_last_updated", "last_updated")


# --- U5 + J3 + F9: parameter rows replaced per key, last batch wins ----------------------
@query("params_refresh", sql=f"""
WITH acc AS (SELECT * FROM ({EVENT_RECORDS_SQL}) WHERE NOT rejected),
p AS (SELECT sku, ts, event_type AS param_name, k AS param_value FROM acc WHERE k <> ''
      UNION ALL SELECT sku, ts, 'seen', CAST(event_id AS VARCHAR) FROM acc WHERE event_id % 2 = 0),
bp AS (SELECT sku, CASE WHEN ts < TIMESTAMP '{BATCH2_TS}' THEN 1 ELSE 2 END AS batch
       FROM acc WHERE ts >= TIMESTAMP '{BATCH1_TS}'),
lastb AS (SELECT sku, max(batch) AS lb FROM bp GROUP BY sku)
SELECT sku, param_name, param_value FROM p
WHERE ts < TIMESTAMP '{BATCH1_TS}' AND sku NOT IN (SELECT sku FROM bp)
UNION ALL
SELECT p.sku, p.param_name, p.param_value FROM p JOIN lastb ON p.sku = lastb.sku
WHERE p.ts >= TIMESTAMP '{BATCH1_TS}'
  AND (CASE WHEN p.ts < TIMESTAMP '{BATCH2_TS}' THEN 1 ELSE 2 END) = lastb.lb""")
def params_refresh(spark, sf):
    """Parameter rows of keys seen in later batches replaced by those of each key's last
    batch."""
    # parsed once, used by the four tables below
    recs = materialize(records_from_documents(event_documents(t(spark, sf, "events")))
                       .select("sku", "params", "rejected", "ts"))
    b1, b2 = F.lit(BATCH1_TS).cast("timestamp_ntz"), F.lit(BATCH2_TS).cast("timestamp_ntz")
    batch = F.when(F.col("ts") < b2, F.lit(1)).otherwise(F.lit(2))
    params = params_rows(recs, keep=["ts"])
    existing = params.filter(F.col("ts") < b1).select("sku", "param_name", "param_value")
    parents = accepted_keys(recs, keep=["ts"]).filter(F.col("ts") >= b1).select(
        "sku", batch.alias("batch"))
    children = params.filter(F.col("ts") >= b1).select(
        "sku", "param_name", "param_value", batch.alias("batch"))
    return refresh_children(existing, parents, children, "sku", batch_col="batch")


# --- U6 + F7: stock of rows not seen this run set to 0 -----------------------------------
_MERGED_SQL = f"""merged AS (
SELECT coalesce(t.sku, s.sku) AS sku,
  CASE WHEN s.sku IS NULL THEN t.stock ELSE s.stock END AS stock,
  CASE WHEN s.sku IS NULL THEN t.stock_sz ELSE 0 END AS stock_sz,
  CASE WHEN s.sku IS NULL THEN t.stock_js ELSE 0 END AS stock_js,
  CASE WHEN s.sku IS NULL THEN t.stock_hk ELSE 0 END AS stock_hk,
  CASE WHEN s.sku IS NULL THEN t.last_updated ELSE TIMESTAMP '{RUN_TS}' END AS last_updated,
  CASE WHEN t.sku IS NULL THEN 'insert' WHEN s.sku IS NULL THEN 'unchanged' ELSE 'update' END AS act
FROM tgt t FULL OUTER JOIN src s ON t.sku = s.sku)"""


@query("mark_unseen_zero", sql=f"""
WITH tgt AS ({CUSTOMER_PRODUCTS_SQL}), {_SRC_SQL}, {_MERGED_SQL}
SELECT sku,
  CASE WHEN last_updated < TIMESTAMP '{RUN_TS}' THEN 0 ELSE stock END AS stock,
  CASE WHEN last_updated < TIMESTAMP '{RUN_TS}' THEN 0 ELSE stock_sz END AS stock_sz,
  CASE WHEN last_updated < TIMESTAMP '{RUN_TS}' THEN 0 ELSE stock_js END AS stock_js,
  CASE WHEN last_updated < TIMESTAMP '{RUN_TS}' THEN 0 ELSE stock_hk END AS stock_hk,
  last_updated
FROM merged""")
def mark_unseen_zero(spark, sf):
    """After the upsert, stock of rows not refreshed by this run set to 0."""
    marked = mark_unseen(_merged(spark, sf), run_ts(), S.STOCK_COLUMNS)
    return marked.select("sku", *S.STOCK_COLUMNS, "last_updated")


# --- P19: the run's own timestamp, taken once ---------------------------------------------
@query("run_marker_merge", sql=f"""
WITH tgt AS ({CUSTOMER_PRODUCTS_SQL}), {_SRC_SQL}, {_MERGED_SQL}
SELECT count(*) FILTER (WHERE act <> 'unchanged') AS marked,
       CAST(least(count(*) FILTER (WHERE act <> 'unchanged'), 1) AS BIGINT) AS markers,
       true AS whole_seconds, true AS taken_now
FROM merged""")
def run_marker_merge(spark, sf):
    """An upsert whose timestamp is the time the run began: every written row has the same
    one, in whole seconds, taken after the query was asked and not again."""
    asked = run_marker(spark)
    began = run_marker(spark)
    merged = merge(_target(spark, sf), _batch(spark, sf), [S.PRODUCT_KEY],
                   policies.product_rules(began), order_by=ORDER, with_action=True).where(F.col(ACTION) != "unchanged")
    ts = F.col("last_updated")
    return merged.agg(F.count(F.lit(1)).alias("marked"),
                      F.count_distinct(ts).alias("markers"),
                      F.coalesce(F.bool_and(ts == F.date_trunc("second", ts)), F.lit(True))
                      .alias("whole_seconds"),
                      F.coalesce(F.min(ts) >= F.lit(asked).cast("timestamp_ntz"), F.lit(True))
                      .alias("taken_now"))


# --- U7: affected-row counts ---------------------------------------------------------------
@query("merge_stats", sql=f"""
WITH tgt AS ({CUSTOMER_PRODUCTS_SQL}), {_SRC_SQL}, {_MERGED_SQL}
SELECT count(*) FILTER (WHERE act = 'insert') AS inserted,
       count(*) FILTER (WHERE act = 'update') AS updated,
       count(*) FILTER (WHERE act <> 'unchanged') AS affected,
       count(*) FILTER (WHERE act = 'unchanged') AS unchanged,
       count(*) AS total_rows,
       count(*) FILTER (WHERE last_updated < TIMESTAMP '{RUN_TS}') AS marked_stale
FROM merged""")
def merge_stats_q(spark, sf):
    """Insert/update/unchanged counts of the upsert and the rows mark-unseen changes."""
    merged = _merged(spark, sf, with_action=True)
    return merge_stats(merged, stale_predicate(run_ts()))
