"""Stand-in inputs: the driver's tables viewed in the schemas the catalog
operators expect.  These adapters rename, cast and derive columns row by row,
union the tree levels, and point a few references nowhere on purpose (so that
left joins meet missing ones); they aggregate nothing and
compute no operator's result.  Every registered query then runs the
library's operators on them, so the work grows with the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partsmith import schemas as S
from partsmith.operators.align import align_schema
from partsmith.operators.ordering import spread
from partsmith.sources.tables import read_table

# fixed value: wall clock of the simulated ingest run (one literal per run)
RUN_TS = "2024-01-20 00:00:00"
# fixed value: last_updated of catalog rows before the run
PRIOR_TS = "2024-01-10 00:00:00"


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def products_from_part(part: DataFrame) -> DataFrame:
    """``part`` as catalog products: key ``'C' || p_partkey``, stock ``p_size``."""
    return align_schema(part.select(
        F.concat(F.lit("C"), F.col("p_partkey").cast("string")).alias("sku"),
        F.col("p_name").alias("mfr_part_number"),
        F.col("p_brand").alias("brand_name"),
        F.col("p_type").alias("package"),
        F.col("p_name").alias("description"),
        F.col("p_size").cast("bigint").alias("category_id"),
        F.col("p_size").cast("bigint").alias("stock"),
        F.concat(F.lit("https://example.com/"), F.col("p_partkey").cast("string"),
                 F.lit(".pdf")).alias("pdf_url"),
    ), S.PRODUCT_SCHEMA)


def products_from_customer(customer: DataFrame) -> DataFrame:
    """``customer`` as catalog products.

    key ``'C' || c_custkey``; category = nation; brand = market segment;
    stock = floor(balance); tier from the segment.  Some NULLs are derived so
    that COALESCE/keep merge paths have work to do."""
    k = F.col("c_custkey")
    return align_schema(customer.select(
        F.concat(F.lit("C"), k.cast("string")).alias("sku"),
        F.col("c_name").alias("mfr_part_number"),
        F.when(k % 3 != 0, F.col("c_mktsegment")).alias("brand_name"),
        F.when(k % 5 != 0, F.concat(F.col("c_name"), F.lit(" "), F.col("c_mktsegment")))
        .alias("description"),
        F.col("c_nationkey").cast("bigint").alias("category_id"),
        F.floor(F.col("c_acctbal")).cast("bigint").alias("stock"),
        (k % 7).alias("stock_sz"),
        F.floor(F.col("c_acctbal")).cast("bigint").alias("vendor_stock"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("Basic"))
        .when(F.col("c_mktsegment") == "MACHINERY", F.lit("Preferred"))
        .otherwise(F.lit("Extended")).alias("vendor_library_type"),
        F.when(k % 7 == 0, F.lit(None).cast("timestamp_ntz"))
        .when(k % 11 == 0, F.lit(RUN_TS).cast("timestamp_ntz"))
        .otherwise(F.lit(PRIOR_TS).cast("timestamp_ntz")).alias("last_updated"),
        F.concat(F.lit('{"c":'), k.cast("string"), F.lit("}")).alias("raw_json"),
    ), S.PRODUCT_SCHEMA)


# SQL twins of the adapters, for the DuckDB oracles.
PART_PRODUCTS_SQL = """
SELECT 'C' || p_partkey AS sku, p_name AS mfr_part_number, p_brand AS brand_name,
       p_type AS package, p_name AS description, CAST(p_size AS BIGINT) AS category_id,
       CAST(NULL AS VARCHAR) AS first_category_name, CAST(NULL AS VARCHAR) AS second_category_name,
       CAST(NULL AS VARCHAR) AS third_category_name,
       CAST(p_size AS BIGINT) AS stock, 'https://example.com/' || p_partkey || '.pdf' AS pdf_url,
       CAST(NULL AS BIGINT) AS vendor_stock, CAST(NULL AS VARCHAR) AS vendor_library_type
FROM part"""

CUSTOMER_PRODUCTS_SQL = f"""
SELECT 'C' || c_custkey AS sku, c_name AS mfr_part_number,
       CAST(NULL AS BIGINT) AS brand_id,
       CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS brand_name,
       CAST(NULL AS VARCHAR) AS package,
       CASE WHEN c_custkey % 5 <> 0 THEN c_name || ' ' || c_mktsegment END AS description,
       CAST(c_nationkey AS BIGINT) AS category_id,
       CAST(NULL AS VARCHAR) AS first_category_name, CAST(NULL AS VARCHAR) AS second_category_name,
       CAST(NULL AS VARCHAR) AS third_category_name,
       CAST(floor(c_acctbal) AS BIGINT) AS stock, c_custkey % 7 AS stock_sz,
       CAST(NULL AS BIGINT) AS stock_js, CAST(NULL AS BIGINT) AS stock_hk,
       CAST(NULL AS VARCHAR) AS pdf_url,
       CAST(floor(c_acctbal) AS BIGINT) AS vendor_stock,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'Basic' WHEN 'MACHINERY' THEN 'Preferred'
            ELSE 'Extended' END AS vendor_library_type,
       CAST(NULL AS VARCHAR) AS vendor_price_ladder, CAST(NULL AS VARCHAR) AS vendor_extra,
       CAST(NULL AS TIMESTAMP) AS vendor_last_updated,
       CASE WHEN c_custkey % 7 = 0 THEN NULL
            WHEN c_custkey % 11 = 0 THEN TIMESTAMP '{RUN_TS}'
            ELSE TIMESTAMP '{PRIOR_TS}' END AS last_updated,
       '{{"c":' || c_custkey || '}}' AS raw_json
FROM customer"""


# ---------------------------------------------------------------------------
# events -> landed product documents (JSON text), with lax value forms
# ---------------------------------------------------------------------------
def _s(x):
    return F.col(x).cast("string") if isinstance(x, str) else x.cast("string")


def event_documents(events: DataFrame) -> DataFrame:
    """One product document per event (JSON text in ``doc``), carrying
    ``event_id``, ``ts`` and ``user_id`` as order/identity columns.

    The document uses API key names and mixes value forms the ingest must
    coerce: stock as "12" / 6.55 / 12.0 / null / "n/a", isHot as true / "yes" /
    0 / 2, a zero catalogId (falls back to wmCatalogId), params with empty
    slots, and a zero minBuyNumber (falsy default)."""
    eid, uid = F.col("event_id"), F.col("user_id")
    k = F.get_json_object(F.col("props"), "$.k")
    fl = F.floor(F.col("value")).cast("bigint")
    stock = (F.when(eid % 5 == 0, F.concat(F.lit('"'), _s(fl), F.lit('"')))
              .when(eid % 5 == 1, _s(F.col("value")))
              .when(eid % 5 == 2, F.concat(_s(fl), F.lit(".0")))
              .when(eid % 5 == 3, F.lit("null"))
              .otherwise(F.lit('"n/a"')))
    hot = (F.when(eid % 4 == 0, F.lit("true")).when(eid % 4 == 1, F.lit('"yes"'))
            .when(eid % 4 == 2, F.lit("0")).otherwise(F.lit("2")))
    brand = F.when(eid % 3 == 0, F.lit("")).otherwise(
        F.concat(F.lit(',"brandNameEn":"'), F.upper(F.col("event_type")), F.lit('"')))
    cat = F.when(eid % 4 == 0, F.lit("0")).otherwise(_s(uid % 25))
    doc = F.concat(
        F.lit('{"productId":'), _s(eid),
        F.lit(',"productCode":"C'), _s(uid * 20), F.lit('"'),
        F.lit(',"productModel":"'), F.col("event_type"), F.lit('"'),
        brand,
        F.lit(',"productIntroEn":"k='), k, F.lit('"'),
        F.lit(',"catalogId":'), cat,
        F.lit(',"wmCatalogId":'), _s(uid % 5 + 100),
        F.lit(',"stockNumber":'), stock,
        F.lit(',"minBuyNumber":'), _s(eid % 3),
        F.lit(',"isHot":'), hot,
        F.lit(',"paramVOList":[{"paramNameEn":"'), F.col("event_type"),
        F.lit('","paramValue":"'), k, F.lit('"},{"paramName":"unit","paramValueEn":""}'),
        F.lit(',{"paramName":"seen","paramValue":"'), F.when(eid % 2 == 0, _s(eid)).otherwise(F.lit("")),
        F.lit('"}]}'))
    return spread(events).select("event_id", "ts", "user_id", doc.alias("doc"))


# SQL twin: the typed record each event document must become.
EVENT_RECORDS_SQL = """
SELECT event_id, ts, user_id, doc, sku, mfr_part_number, brand_name, description, category_id,
       stock, moq, is_hot, stock_bad OR hot_bad AS rejected,
       CASE WHEN stock_bad OR hot_bad THEN concat_ws(',', CASE WHEN stock_bad THEN 'stockNumber' END,
                                                      CASE WHEN hot_bad THEN 'isHot' END) END AS reject_reason,
       k, event_type
FROM (
  SELECT event_id, ts, user_id, event_type, k,
    '{"productId":' || event_id || ',"productCode":"C' || (user_id * 20) || '"'
    || ',"productModel":"' || event_type || '"'
    || CASE WHEN event_id % 3 = 0 THEN '' ELSE ',"brandNameEn":"' || upper(event_type) || '"' END
    || ',"productIntroEn":"k=' || k || '"'
    || ',"catalogId":' || CASE WHEN event_id % 4 = 0 THEN '0' ELSE CAST(user_id % 25 AS VARCHAR) END
    || ',"wmCatalogId":' || (user_id % 5 + 100)
    || ',"stockNumber":' || CASE event_id % 5
          WHEN 0 THEN '"' || CAST(floor(value) AS BIGINT) || '"'
          WHEN 1 THEN CAST(value AS VARCHAR)
          WHEN 2 THEN CAST(floor(value) AS BIGINT) || '.0'
          WHEN 3 THEN 'null' ELSE '"n/a"' END
    || ',"minBuyNumber":' || (event_id % 3)
    || ',"isHot":' || CASE event_id % 4 WHEN 0 THEN 'true' WHEN 1 THEN '"yes"' WHEN 2 THEN '0' ELSE '2' END
    || ',"paramVOList":[{"paramNameEn":"' || event_type || '","paramValue":"' || k
    || '"},{"paramName":"unit","paramValueEn":""},{"paramName":"seen","paramValue":"'
    || CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS VARCHAR) ELSE '' END || '"}]}' AS doc,
    'C' || (user_id * 20) AS sku,
    event_type AS mfr_part_number,
    CASE WHEN event_id % 3 = 0 THEN NULL ELSE upper(event_type) END AS brand_name,
    'k=' || k AS description,
    CAST(CASE WHEN event_id % 4 = 0 OR user_id % 25 = 0 THEN user_id % 5 + 100 ELSE user_id % 25 END AS BIGINT) AS category_id,
    CAST(CASE event_id % 5
          WHEN 0 THEN floor(value)
          WHEN 1 THEN CASE WHEN value = floor(value) THEN floor(value) END
          WHEN 2 THEN floor(value)
          WHEN 3 THEN 0 ELSE NULL END AS BIGINT) AS stock,
    CAST(CASE WHEN event_id % 3 = 0 THEN 1 ELSE event_id % 3 END AS BIGINT) AS moq,
    CAST(CASE event_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 0 ELSE 0 END AS BIGINT) AS is_hot,
    (event_id % 5 = 1 AND value <> floor(value)) OR event_id % 5 = 4 AS stock_bad,
    event_id % 4 = 3 AS hot_bad
  FROM (SELECT *, json_extract_string(props, '$.k') AS k FROM events)
)"""


# ---------------------------------------------------------------------------
# category tree: region (root) -> nation -> customer (leaf), as an adjacency list
# ---------------------------------------------------------------------------
def categories_from_tables(region: DataFrame, nation: DataFrame, customer: DataFrame) -> DataFrame:
    """Adjacency list ``id, parent_id, name_en, name_cn, code`` of a three-level
    tree that grows with ``customer``.  Some leaves have an empty English name
    (and a local name), a few have neither, so name fallbacks have work."""
    k = F.col("c_custkey")
    roots = region.select((F.col("r_regionkey") + 1).cast("bigint").alias("id"),
                          F.lit(None).cast("bigint").alias("parent_id"),
                          F.col("r_name").alias("name_en"),
                          F.lit(None).cast("string").alias("name_cn"),
                          F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("code"))
    mids = nation.select((F.col("n_nationkey") + 100).cast("bigint").alias("id"),
                         (F.col("n_regionkey") + 1).cast("bigint").alias("parent_id"),
                         F.col("n_name").alias("name_en"),
                         F.lower(F.col("n_name")).alias("name_cn"),
                         F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("code"))
    leaves = customer.select((k + 1000).cast("bigint").alias("id"),
                             (F.col("c_nationkey") + 100).cast("bigint").alias("parent_id"),
                             F.when(k % 13 == 0, F.lit("")).otherwise(F.col("c_name")).alias("name_en"),
                             F.when(k % 26 == 0, F.lit(None).cast("string"))
                             .when(k % 13 == 0, F.concat(F.lit("cn-"), k.cast("string")))
                             .alias("name_cn"),
                             F.lit(None).cast("string").alias("code"))
    return roots.unionByName(mids).unionByName(leaves)


CATEGORIES_SQL = """
SELECT CAST(r_regionkey + 1 AS BIGINT) AS id, CAST(NULL AS BIGINT) AS parent_id, r_name AS name_en,
       CAST(NULL AS VARCHAR) AS name_cn, 'R' || r_regionkey AS code FROM region
UNION ALL
SELECT CAST(n_nationkey + 100 AS BIGINT), CAST(n_regionkey + 1 AS BIGINT), n_name, lower(n_name),
       'N' || n_nationkey FROM nation
UNION ALL
SELECT CAST(c_custkey + 1000 AS BIGINT), CAST(c_nationkey + 100 AS BIGINT),
       CASE WHEN c_custkey % 13 = 0 THEN '' ELSE c_name END,
       CASE WHEN c_custkey % 26 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN 'cn-' || c_custkey END,
       CAST(NULL AS VARCHAR) FROM customer"""


def vendor_rows_from_events(events: DataFrame) -> DataFrame:
    """Second-vendor rows keyed like catalog products (half of them match an
    existing product), with ``ts``/``event_id`` as the order of arrival."""
    from partsmith.functions.coerce import epoch_to_timestamp, tier_label, timestamp_to_epoch_sql
    eid, uid, et = F.col("event_id"), F.col("user_id"), F.col("event_type")
    return events.select(
        F.concat(F.lit("C"), (uid * 20).cast("string")).alias("sku"),
        et.alias("mfr_part_number"),
        F.when(eid % 3 != 0, F.upper(et)).alias("brand_name"),
        F.concat(F.lit("k="), F.get_json_object("props", "$.k")).alias("description"),
        (uid % 25).alias("category_id"),
        F.concat(F.lit("https://example.com/"), uid.cast("string"), F.lit(".pdf")).alias("pdf_url"),
        F.floor(F.col("value")).cast("bigint").alias("vendor_stock"),
        F.col("props").alias("vendor_price_ladder"),
        tier_label("CASE WHEN event_type = 'view' THEN 1 ELSE 0 END",
                   "CASE WHEN event_type = 'click' THEN 1 WHEN event_type = 'error' THEN NULL "
                   "ELSE 0 END").alias("vendor_library_type"),
        F.concat(F.lit('{"e":'), eid.cast("string"), F.lit("}")).alias("vendor_extra"),
        epoch_to_timestamp(timestamp_to_epoch_sql("ts")).alias("vendor_last_updated"),
        "ts", "event_id")


VENDOR_ROWS_SQL = """
SELECT 'C' || (user_id * 20) AS sku, event_type AS mfr_part_number,
       CASE WHEN event_id % 3 <> 0 THEN upper(event_type) END AS brand_name,
       'k=' || json_extract_string(props, '$.k') AS description,
       user_id % 25 AS category_id, 'https://example.com/' || user_id || '.pdf' AS pdf_url,
       CAST(floor(value) AS BIGINT) AS vendor_stock, props AS vendor_price_ladder,
       CASE WHEN event_type = 'view' THEN 'Basic' WHEN event_type = 'click' THEN 'Preferred'
            ELSE 'Extended' END AS vendor_library_type,
       '{"e":' || event_id || '}' AS vendor_extra,
       CAST(date_trunc('second', ts) AS TIMESTAMP) AS vendor_last_updated, ts, event_id
FROM events"""


# ---------------------------------------------------------------------------
# second vendor's bulk tables: components <- lineitem, categories <- supplier,
# manufacturers <- part (some references point nowhere -> left-join NULLs)
# ---------------------------------------------------------------------------
def vendor_tables(lineitem: DataFrame, supplier: DataFrame, part: DataFrame):
    ln = F.col("l_linenumber")
    comps = lineitem.select(
        (F.col("l_orderkey") * 10 + ln).cast("bigint").alias("part_code"),
        F.when(F.col("l_orderkey") % 32 == 0, -1 - F.col("l_suppkey")).otherwise(F.col("l_suppkey"))
        .cast("bigint").alias("category_id"),
        F.concat(F.lit("MFR-"), F.col("l_partkey").cast("string")).alias("mfr"),
        F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("package"),
        ln.cast("bigint").alias("joints"),
        F.when(F.col("l_orderkey") % 50 == 1, -1 - F.col("l_partkey")).otherwise(F.col("l_partkey"))
        .cast("bigint").alias("manufacturer_id"),
        F.when(F.col("l_returnflag") == "A", 1).otherwise(0).cast("bigint").alias("basic"),
        F.concat(F.lit("line "), ln.cast("string"), F.lit(" of "),
                 F.col("l_orderkey").cast("string")).alias("description"),
        F.concat(F.lit("https://example.com/ds/"), F.col("l_partkey").cast("string"),
                 F.lit(".pdf")).alias("datasheet"),
        F.col("l_quantity").cast("bigint").alias("stock"),
        F.concat(F.lit('[{"qFrom":1,"cents":'),
                 F.floor(F.col("l_extendedprice") * 100).cast("bigint").cast("string"),
                 F.lit("}]")).alias("price"),
        F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("last_update"),
        F.when(ln % 2 == 1, F.concat(F.lit('{"n":'), ln.cast("string"), F.lit("}"))).alias("extra"),
        F.lit(0).cast("bigint").alias("flag"),
        F.lit(0).cast("bigint").alias("last_on_stock"),
        F.when(F.col("l_linestatus") == "O", 1).when(ln == 7, None).otherwise(0).cast("bigint")
        .alias("preferred"))
    cats = supplier.select(
        F.col("s_suppkey").cast("bigint").alias("id"),
        F.concat(F.lit("Cat-"), F.col("s_nationkey").cast("string")).alias("category"),
        F.col("s_name").alias("subcategory"))
    mfrs = part.select(
        F.col("p_partkey").cast("bigint").alias("id"),
        F.concat(F.col("p_brand"), F.lit(" "), F.col("p_name")).alias("name"))
    return comps, cats, mfrs

