"""Document ingest queries: alias projection, lax coercion with rejects,
falsy defaults, flags, category fallback, parameter explode, JSON text of
nested lists, raw document retention, keyless drop, page envelopes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from partsmith.functions import coerce as C
from partsmith.operators.ingest import drop_keyless, params_rows, records_from_documents
from partsmith.operators.ordering import spread
from partsmith.plans.bindings import EVENT_RECORDS_SQL, event_documents, t
from partsmith.plans.registry import query
from partsmith.sources.documents import inline_pages


def _records(spark, sf, include_raw_json=True):
    return records_from_documents(event_documents(t(spark, sf, "events")), include_raw_json)


# --- P1: API names -> canonical columns ----------------------------------------
@query("project_aliases", sql=f"""
SELECT event_id, sku, mfr_part_number, brand_name, description
FROM ({EVENT_RECORDS_SQL})""")
def project_aliases(spark, sf):
    """Event documents mapped from API key names to canonical columns."""
    return _records(spark, sf).select("event_id", "sku", "mfr_part_number", "brand_name",
                                      "description")


# --- P2: lax coercion; failures routed to rejects with a reason ------------------
@query("coerce_and_reject", sql=f"""
SELECT event_id, CASE WHEN rejected THEN NULL ELSE stock END AS stock,
       CASE WHEN rejected THEN NULL ELSE is_hot END AS is_hot, rejected, reject_reason
FROM ({EVENT_RECORDS_SQL})""")
def coerce_and_reject(spark, sf):
    """Lax coercion of stock and the hot flag; records that fail are flagged with the
    failing keys."""
    r = _records(spark, sf)
    return r.select(
        "event_id",
        F.when(~F.col("rejected"), F.col("stock")).alias("stock"),
        F.when(~F.col("rejected"), F.col("is_hot")).alias("is_hot"),
        "rejected", "reject_reason")


# --- P3: falsy defaults (stock: missing -> 0, moq: 0 -> 1) -----------------------
@query("default_fill", sql=f"""
SELECT event_id, stock, moq, CAST(0 AS BIGINT) AS stock_sz, CAST(1 AS BIGINT) AS spq,
       CAST(0.0 AS DOUBLE) AS reel_price
FROM ({EVENT_RECORDS_SQL}) WHERE NOT rejected""")
def default_fill(spark, sf):
    """Falsy defaults on accepted records (missing or zero stock -> 0, zero moq -> 1, ...)."""
    r = _records(spark, sf).filter(~F.col("rejected"))
    return r.select("event_id", "stock", "moq", "stock_sz", "spq", "reel_price")


# --- P4: boolean -> 0/1 ----------------------------------------------------------
@query("flag_to_int", sql=f"""
SELECT event_id, is_hot, CAST(0 AS BIGINT) AS is_rohs
FROM ({EVENT_RECORDS_SQL}) WHERE NOT rejected""")
def flag_to_int(spark, sf):
    """Boolean flags as 0/1 on accepted records."""
    r = _records(spark, sf).filter(~F.col("rejected"))
    return r.select("event_id", "is_hot", "is_rohs")


# --- P5: category id falls back when the first id is 0 ---------------------------
@query("category_fallback", sql=f"""
SELECT event_id, category_id FROM ({EVENT_RECORDS_SQL})""")
def category_fallback(spark, sf):
    """Category id falls back to the second id when the first is 0 or missing."""
    return _records(spark, sf).select("event_id", "category_id")


# --- N1 + P6: parameters to child rows, en -> local -> "" fallback, empties dropped
@query("params_explode", sql=f"""
WITH r AS ({EVENT_RECORDS_SQL})
SELECT sku, event_id, CAST(0 AS INTEGER) AS param_pos, event_type AS param_name, k AS param_value
FROM r WHERE NOT rejected AND k <> ''
UNION ALL
SELECT sku, event_id, CAST(2 AS INTEGER), 'seen', CAST(event_id AS VARCHAR)
FROM r WHERE NOT rejected AND event_id % 2 = 0""")
def params_explode(spark, sf):
    """Parameter rows of accepted records, name/value falling back en -> local -> '',
    empties dropped."""
    return params_rows(_records(spark, sf), keep=["event_id"]).select(
        "sku", "event_id", "param_pos", "param_name", "param_value")


# --- P7: array of structs -> JSON text with NULL fields kept --------------------------
@query("price_ladder_json", sql="""
WITH l AS (
  SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_returnflag FROM lineitem
), tiers AS (
  SELECT l_orderkey, l_linenumber, 0 AS tier_pos, CAST(1 AS BIGINT) AS ladder, l_extendedprice AS usd_price,
         NULL AS note FROM l
  UNION ALL
  SELECT l_orderkey, l_linenumber, 1, CAST(l_quantity AS BIGINT), CASE WHEN l_discount > 0.05 THEN l_discount END,
         CASE WHEN l_linenumber % 2 = 0 THEN l_returnflag END FROM l
)
SELECT l_orderkey, l_linenumber, tier_pos, ladder, usd_price,
       (tier_pos = 1 AND usd_price IS NULL) AS null_kept, note
FROM tiers WHERE l_orderkey % 10 <> 0
UNION ALL
SELECT l_orderkey, l_linenumber, NULL, NULL, NULL, false, NULL FROM l WHERE l_orderkey % 10 = 0""")
def price_ladder_json(spark, sf):
    """Build a document with a two-tier ladder per line (the second price may be NULL, its
    entry may have a key of its own), coerce it, render it as JSON text, then read the text
    back into rows: the round trip shows that NULL fields (``"usdPrice":null``) and unknown
    keys survive and that a line without a ladder is written as ``[]`` (it reads back as
    one row with no tier)."""
    li = spread(t(spark, sf, "lineitem"))  # per-row JSON work: use every core
    # numbers come as text, too; absent keys stay absent
    first = F.to_json(F.struct(F.lit("1").alias("ladder"),
                               F.col("l_extendedprice").alias("usdPrice")))
    second = F.to_json(F.struct(
        F.when(F.col("l_linenumber") % 2 == 0, F.col("l_returnflag")).alias("note"),
        F.col("l_quantity").cast("bigint").alias("ladder"),
        F.when(F.col("l_discount") > 0.05, F.col("l_discount")).alias("usdPrice")))
    doc = F.concat(F.lit('{"productCode":"x"'), F.when(
        F.col("l_orderkey") % 10 != 0,
        F.concat(F.lit(',"productPriceList":['), first, F.lit(","), second, F.lit("]")))
        .otherwise(""), F.lit("}"))
    js = records_from_documents(li.select("l_orderkey", "l_linenumber", doc.alias("doc")),
                                include_raw_json=False)
    back = F.from_json("price_ladder", "array<struct<ladder:bigint,usdPrice:double,note:string>>")
    return js.select("l_orderkey", "l_linenumber", "price_ladder",
                     F.posexplode_outer(back).alias("tier_pos", "t")).select(
        "l_orderkey", "l_linenumber", "tier_pos",
        F.col("t.ladder").alias("ladder"), F.col("t.usdPrice").alias("usd_price"),
        F.coalesce((F.col("tier_pos") == 1) & F.col("price_ladder").contains('"usdPrice":null'),
                   F.lit(False)).alias("null_kept"), F.col("t.note").alias("note"))


# --- P8: raw document kept (or not) -------------------------------------------------
@query("raw_json_keep", sql=f"""
SELECT event_id, collected, CASE WHEN collected THEN doc END AS raw_json, category_id, moq
FROM ({EVENT_RECORDS_SQL}), (VALUES (true), (false)) c(collected)""")
def raw_json_keep(spark, sf):
    """The raw document is kept when collected and NULL when not; other columns are parsed
    either way."""
    return reduce(lambda a, b: a.unionByName(b), [
        _records(spark, sf, include_raw_json=on).select(
            "event_id", F.lit(on).alias("collected"), "raw_json", "category_id", "moq")
        for on in (True, False)])


# --- F6: records without a key never become rows -------------------------------------
@query("drop_keyless", sql="""
SELECT sku, o_orderkey FROM (
  SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 7 = 1 THEN ''
                          ELSE 'C' || o_orderkey END AS sku FROM orders)
WHERE coalesce(sku, '') <> ''""")
def drop_keyless_q(spark, sf):
    """Records with a NULL or empty key never become rows."""
    o = t(spark, sf, "orders")
    k = F.col("o_orderkey")
    keyed = o.select("o_orderkey", F.when(k % 7 == 0, F.lit(None).cast("string"))
                     .when(k % 7 == 1, F.lit("")).otherwise(F.concat(F.lit("C"), k.cast("string")))
                     .alias("sku"))
    return drop_keyless(keyed, "sku").select("sku", "o_orderkey")


# --- S1: page envelopes inlined to rows, keeping page and position -------------------
@query("scan_pages_inline", sql="""
SELECT conv_id, turn, role, CAST(turn // 10 + 1 AS BIGINT) AS page,
       CAST(row_number() OVER (PARTITION BY conv_id, turn // 10 ORDER BY turn) - 1 AS INTEGER) AS pos,
       count(*) OVER (PARTITION BY conv_id, turn // 10) AS total_row
FROM conversations""")
def scan_pages_inline(spark, sf):
    """``conversations`` landed as page envelopes of at most 10 turns (one JSON
    line per page), then scanned back: envelope parse + posexplode."""
    conv = t(spark, sf, "conversations")
    pg = (F.floor(F.col("turn") / 10) + 1).cast("bigint")
    item = F.to_json(F.struct(F.col("conv_id").alias("convId"), F.col("turn"),
                              F.col("role"), F.col("text")))
    envelopes = (conv.groupBy("conv_id", pg.alias("page"))
                 .agg(F.sort_array(F.collect_list(F.struct("turn", item.alias("j")))).alias("items"))
                 .select("conv_id", F.to_json(F.struct(
                     F.transform("items", lambda x: F.parse_json(x["j"])).alias("dataList"),
                     F.size("items").alias("totalRow"),
                     F.col("page").alias("currPage"),
                     F.lit(None).cast("bigint").alias("totalPage"))).alias("doc")))
    rows = inline_pages(envelopes)
    item_schema = "convId bigint, turn bigint, role string, text string"
    parsed = rows.select("page", "pos", "total_row", F.from_json("doc", item_schema).alias("x"))
    return parsed.select(F.col("x.convId").alias("conv_id"), F.col("x.turn").alias("turn"),
                         F.col("x.role").alias("role"), "page", "pos", "total_row")
