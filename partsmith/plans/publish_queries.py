"""Published variants, schema alignment, size report, manifest merge and
embedded-metadata extraction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from partsmith import schemas as S
from partsmith.functions.formatting import embedded_json, pct_change
from partsmith.operators.align import align_schema
from partsmith.operators.merge import Rule, merge
from partsmith.operators.report import (
    format_size_exact,
    in_rank_order,
    manifest_rows,
    merge_manifest,
    variant_stats,
)
from partsmith.operators.ordering import materialize
from partsmith.operators.variants import (
    asset_labels,
    build_variant,
    generate_variants,
    kept_columns,
    write_tables,
)
from partsmith.plans.bindings import (
    CATEGORIES_SQL,
    CUSTOMER_PRODUCTS_SQL,
    PART_PRODUCTS_SQL,
    VENDOR_ROWS_SQL,
    categories_from_tables,
    products_from_customer,
    products_from_part,
    t,
    vendor_rows_from_events,
)
from partsmith.plans.merge_queries import (
    _SRC_SQL,
    ORDER,
    _batch,
    _target,
    overlay_rules,
    product_rules,
)
from partsmith.plans.registry import query
from partsmith.plans.sqlbits import q
from partsmith.session import scratch_path
from partsmith.sources.tables import read_optional

ASSETS = asset_labels()
ASSET_ORDER = list(ASSETS)
REPORT_TS = "2024-01-20 00:00:00 UTC"


def _base(products):
    return {"products": products, "categories": None}


def _variant_stats(products, names, baseline=None):
    """Stats of the named assets of one products table."""
    return variant_stats(products, {n: kept_columns(n) for n in names}, baseline)


# SQL twins: logical bytes per row of the two product adapters
_CUST_BYTES = """(strlen(sku) + strlen(mfr_part_number) + coalesce(strlen(brand_name), 0)
  + coalesce(strlen(description), 0) + 8 + 8 + 8 + 8 + strlen(vendor_library_type)
  + CASE WHEN last_updated IS NOT NULL THEN 8 ELSE 0 END)"""
_PART_BYTES = """(strlen(sku) + strlen(mfr_part_number) + strlen(brand_name) + strlen(package)
  + strlen(description) + 8 + 8 + strlen(pdf_url))"""


def _size_text_sql(b: str) -> str:
    def dec(unit: int) -> str:
        q = f"(({b}) * 100 // {unit})"
        r = f"(({b}) * 100 % {unit})"
        cents = f"({q} + CASE WHEN 2 * {r} > {unit} OR (2 * {r} = {unit} AND {q} % 2 = 1) THEN 1 ELSE 0 END)"
        return f"CAST({cents} // 100 AS VARCHAR) || '.' || lpad(CAST({cents} % 100 AS VARCHAR), 2, '0')"
    return (f"CASE WHEN ({b}) IS NULL THEN 'N/A' WHEN ({b}) >= 1073741824 THEN {dec(1073741824)} || ' GB' "
            f"WHEN ({b}) >= 1048576 THEN {dec(1048576)} || ' MB' "
            f"WHEN ({b}) >= 1024 THEN {dec(1024)} || ' KB' ELSE CAST(({b}) AS VARCHAR) || ' B' END")


def _rank_sql(col: str) -> str:
    return ("CASE " + " ".join(f"WHEN {col} = '{n}' THEN {i}" for i, n in enumerate(ASSET_ORDER))
            + " ELSE 999 END")


# --- K1 + V2: search table (every column but the raw document) and categories, as written --
_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP"}
_HELD = ("sku mfr_part_number brand_id brand_name package description category_id"
         " first_category_name second_category_name third_category_name stock stock_sz stock_js"
         " stock_hk pdf_url vendor_stock vendor_price_ladder vendor_library_type vendor_extra"
         " vendor_last_updated last_updated").split()
_SEARCH_SQL = ", ".join(
    c if c in _HELD else f"CAST(NULL AS {_DUCK[S.PRODUCT_SCHEMA[c].dataType.simpleString()]}) AS {c}"
    for c in S.SEARCH_COLUMNS)


@query("search_docs_build", sql=f"""
SELECT {_SEARCH_SQL}, (SELECT count(*) FROM ({CATEGORIES_SQL})) AS n_categories
FROM ({CUSTOMER_PRODUCTS_SQL})""")
def search_docs_build(spark, sf):
    """The search-only variant as written: every column but the raw document of its search
    table, and how many categories stand beside it."""
    cats = categories_from_tables(t(spark, sf, "region"), t(spark, sf, "nation"),
                                  t(spark, sf, "customer"))
    base = {"products": products_from_customer(t(spark, sf, "customer")), "categories": cats}
    paths = write_tables(build_variant(base, "search_only"), scratch_path(spark, "search"))
    docs, held = (spark.read.parquet(paths[n]) for n in ("search_docs", "categories"))
    return docs.select(*docs.columns, held.agg(F.count(F.lit(1))).scalar().alias("n_categories"))


# --- V3 + P18: raw document cleared ---------------------------------------------------
@query("variant_no_raw_json", sql=f"""
SELECT sku, mfr_part_number, CAST(NULL AS VARCHAR) AS raw_json, category_id, brand_name, stock,
       description, vendor_library_type, last_updated FROM ({CUSTOMER_PRODUCTS_SQL})""")
def variant_no_raw_json(spark, sf):
    """The variant with the raw document cleared, as written."""
    out = generate_variants(_base(products_from_customer(t(spark, sf, "customer"))),
                            scratch_path(spark, "variants"), ["no_raw_json"])
    return spark.read.parquet(out[0]["tables"]["products"]).select(
        "sku", "mfr_part_number", "raw_json", "category_id", "brand_name", "stock",
        "description", "vendor_library_type", "last_updated")


# --- V4 + K3 + R1: all variants, or some, with plain and compressed sizes -------------
_SIZED = [("all", ["search_only", "no_raw_json", "minimal"]), ("some", ["minimal"])]


@query("variants_selected", sql=" UNION ALL ".join(
    f"SELECT '{asked}' AS asked, '{v}' AS variant, '{tab}' AS table_name, 'none' AS codec,"
    f" 'zstd' AS archive_codec, (SELECT count(*) FROM {src}) AS rows, true AS archive_is_smaller"
    for asked, names in _SIZED for v in names
    for tab, src in (("search_docs" if v == "search_only" else "products", "customer"),
                     ("categories", f"({CATEGORIES_SQL})"))))
def variants_selected(spark, sf):
    """All variants and a selection, written plain and as compressed archives: codec of the
    written files, their rows, and whether the archive of the variant is smaller."""
    cats = categories_from_tables(t(spark, sf, "region"), t(spark, sf, "nation"),
                                  t(spark, sf, "customer"))
    base = {"products": products_from_customer(t(spark, sf, "customer")), "categories": cats}
    root = scratch_path(spark, "variants")

    def codec(df):
        name = F.regexp_extract(F.col("_metadata.file_name"), r"\.([a-z0-9]+)\.parquet$", 1)
        return F.coalesce(F.nullif(name, F.lit("")), F.lit("none"))

    out = []
    for asked, names in _SIZED:
        for res in generate_variants(base, f"{root}/{asked}", None if asked == "all" else names,
                                     compression="uncompressed", archive="zstd"):
            less = res["archive_size_bytes"] < res["db_size_bytes"]
            for name, path in res["tables"].items():
                packed = spark.read.parquet(f"{res['path']}.archive/{name}")
                plain = spark.read.parquet(path)
                out.append(plain.select(codec(plain).alias("codec")).groupBy("codec").agg(
                    F.count(F.lit(1)).alias("rows")).select(
                    F.lit(asked).alias("asked"), F.lit(res["variant"]).alias("variant"),
                    F.lit(name).alias("table_name"), "codec",
                    packed.select(codec(packed).alias("c")).agg(F.max("c")).scalar()
                    .alias("archive_codec"), "rows", F.lit(less).alias("archive_is_smaller")))
    return reduce(lambda a, b: a.unionByName(b), out)


# --- S7: sources that are there and that aren't -----------------------------------------
@query("optional_sources", sql="""
SELECT 'customer' AS source, c_mktsegment AS segment, count(*) AS rows FROM customer GROUP BY ALL
UNION ALL SELECT 'absent', NULL, 0""")
def optional_sources(spark, sf):
    """Rows of a source that exists, and of one that doesn't (read as empty)."""
    schema = t(spark, sf, "customer").schema
    there = read_optional(spark, f"{sf}/customer.parquet", schema)
    absent = read_optional(spark, f"{sf}/no_such_table.parquet", schema)
    return (there.groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("rows"))
            .select(F.lit("customer").alias("source"), "segment", "rows")
            .unionByName(absent.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit("absent").alias("source"), F.lit(None).cast("string").alias("segment"),
                "rows")))


# --- V5: primary-vendor-only vs integrated snapshots -------------------------------------
@query("variant_single_vendor", sql=f"""
WITH tgt AS ({CUSTOMER_PRODUCTS_SQL}), {_SRC_SQL},
m1 AS (SELECT coalesce(t.sku, s.sku) AS sku,
         CASE WHEN s.sku IS NULL THEN t.brand_name ELSE s.brand_name END AS brand_name,
         CASE WHEN s.sku IS NULL THEN t.description ELSE s.description END AS description,
         CASE WHEN s.sku IS NULL THEN t.vendor_stock ELSE 0 END AS vendor_stock,
         CASE WHEN s.sku IS NULL THEN t.vendor_library_type END AS vendor_library_type
       FROM tgt t FULL OUTER JOIN src s ON t.sku = s.sku),
vs AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sku ORDER BY ts DESC, event_id DESC) AS rn
                      FROM ({VENDOR_ROWS_SQL})) WHERE rn = 1),
m2 AS (SELECT coalesce(m.sku, v.sku) AS sku,
         CASE WHEN v.sku IS NULL THEN m.brand_name WHEN m.sku IS NULL THEN v.brand_name
              ELSE coalesce(m.brand_name, v.brand_name) END AS brand_name,
         CASE WHEN v.sku IS NULL THEN m.description WHEN m.sku IS NULL THEN v.description
              ELSE coalesce(m.description, v.description) END AS description,
         CASE WHEN v.sku IS NULL THEN m.vendor_stock ELSE v.vendor_stock END AS vendor_stock,
         CASE WHEN v.sku IS NULL THEN m.vendor_library_type ELSE v.vendor_library_type END AS vendor_library_type
       FROM m1 m FULL OUTER JOIN vs v ON m.sku = v.sku)
SELECT 'primary_only' AS variant, * FROM m1 UNION ALL SELECT 'integrated', * FROM m2""")
def variant_single_vendor(spark, sf):
    """Primary-only catalog (after the document upsert) and integrated catalog (after the
    vendor overlay)."""
    # used twice below, so written once
    primary = materialize(merge(_target(spark, sf), _batch(spark, sf), [S.PRODUCT_KEY],
                                product_rules(), order_by=ORDER))
    integrated = merge(primary, vendor_rows_from_events(t(spark, sf, "events")), [S.PRODUCT_KEY],
                       overlay_rules(), default=Rule("keep", "source"), order_by=ORDER)
    cols = ["sku", "brand_name", "description", "vendor_stock", "vendor_library_type"]
    return (primary.select(F.lit("primary_only").alias("variant"), *cols)
            .unionByName(integrated.select(F.lit("integrated").alias("variant"), *cols)))


# --- M1 + M2: an old table brought to the current schema -----------------------------------
def _aligned_sql(column: str) -> str:
    if column == "vendor_stock":
        return "CAST(0 AS BIGINT) AS vendor_stock"
    if column in _HELD and column not in S.VENDOR_COLUMNS:
        return column
    return f"CAST(NULL AS {_DUCK[S.PRODUCT_SCHEMA[column].dataType.simpleString()]}) AS {column}"


@query("align_schema", sql=f"""
SELECT {", ".join(map(_aligned_sql, S.PRODUCT_COLUMNS))} FROM ({CUSTOMER_PRODUCTS_SQL})""")
def align_schema_q(spark, sf):
    """A table without the raw-document and vendor columns brought to the current schema
    with defaults."""
    legacy_cols = [c for c in S.PRODUCT_COLUMNS if c != "raw_json" and c not in S.VENDOR_COLUMNS]
    legacy = products_from_customer(t(spark, sf, "customer")).select(*legacy_cols)
    return align_schema(legacy, S.PRODUCT_SCHEMA, defaults={"vendor_stock": 0})


# --- R1-R3 + P14 + P17 + T3: size report against the base -------------------------------------
@query("size_report", sql=f"""
WITH p AS ({CUSTOMER_PRODUCTS_SQL}),
s AS (SELECT 'catalog' AS name, count(*) AS rows, CAST(sum({_CUST_BYTES} + strlen(raw_json)) AS BIGINT) AS logical_bytes FROM p
      UNION ALL SELECT 'search_only', count(*), CAST(sum({_CUST_BYTES}) AS BIGINT) FROM p
      UNION ALL SELECT 'no_raw_json', count(*), CAST(sum({_CUST_BYTES}) AS BIGINT) FROM p),
b AS (SELECT logical_bytes AS base FROM s WHERE name = 'catalog')
SELECT name, rows, logical_bytes, {_size_text_sql('logical_bytes')} AS size_text,
       CASE WHEN base > 0 THEN (CAST(logical_bytes AS DOUBLE) - CAST(base AS DOUBLE)) / CAST(base AS DOUBLE) * CAST(100 AS DOUBLE)
            ELSE CAST(0 AS DOUBLE) END AS pct_vs_base,
       {_rank_sql('name')} AS rank
FROM s, b""")
def size_report(spark, sf):
    """Rows and logical bytes of three variants, size text, percent against the base, fixed
    order."""
    stats = _variant_stats(products_from_customer(t(spark, sf, "customer")),
                           ASSET_ORDER[:3], "catalog")
    stats = stats.withColumn("pct_vs_base", pct_change("logical_bytes", F.col("base_bytes")))
    out = in_rank_order(stats, "name", ASSET_ORDER)
    return out.select("name", "rows", "logical_bytes",
                      format_size_exact("logical_bytes").alias("size_text"), "pct_vs_base", "rank")


# --- O2 + R2: manifest merge (new entries replace old ones by asset) -----------------------------
def _manifest_sql(select_sql: str) -> str:
    cases = {k: [] for k in ("variant", "archive_name", "description")}
    for a, meta in ASSETS.items():
        for k in cases:
            cases[k].append(f"WHEN name = '{a}' THEN {q(meta[k])}")
    v = "CASE " + " ".join(cases["variant"]) + " ELSE name END"
    ar = "CASE " + " ".join(cases["archive_name"]) + " ELSE name || '.tar.xz' END"
    d = "CASE " + " ".join(cases["description"]) + " ELSE 'Database variant' END"
    return (f"SELECT name AS asset, {v} AS variant, {ar} AS archive_name, {d} AS description, "
            f"logical_bytes AS db_size_bytes, CAST(NULL AS BIGINT) AS archive_size_bytes, "
            f"'{REPORT_TS}' AS last_updated FROM ({select_sql})")


@query("manifest_merge", sql=f"""
WITH c AS ({CUSTOMER_PRODUCTS_SQL}), pp AS ({PART_PRODUCTS_SQL}),
old AS ({_manifest_sql(f'''
  SELECT 'catalog' AS name, CAST(sum({_CUST_BYTES} + strlen(raw_json)) AS BIGINT) AS logical_bytes FROM c
  UNION ALL SELECT 'search_only', CAST(sum({_CUST_BYTES}) AS BIGINT) FROM c
  UNION ALL SELECT 'no_raw_json', CAST(sum({_CUST_BYTES}) AS BIGINT) FROM c
  UNION ALL SELECT 'minimal', CAST(sum({_CUST_BYTES}) AS BIGINT) FROM c''')}),
new AS ({_manifest_sql(f'''
  SELECT 'catalog' AS name, CAST(sum({_PART_BYTES}) AS BIGINT) AS logical_bytes FROM pp
  UNION ALL SELECT 'search_only', CAST(sum({_PART_BYTES}) AS BIGINT) FROM pp''')}),
m AS (SELECT * FROM new UNION ALL SELECT * FROM old WHERE asset NOT IN (SELECT asset FROM new))
SELECT *, {_size_text_sql('db_size_bytes')} AS size_text, {_rank_sql('asset')} AS rank FROM m""")
def manifest_merge(spark, sf):
    """Manifest of earlier variants merged with newer statistics by asset."""
    old_stats = _variant_stats(products_from_customer(t(spark, sf, "customer")),
                               ASSET_ORDER)
    new_stats = _variant_stats(products_from_part(t(spark, sf, "part")),
                               ASSET_ORDER[:2])
    old = manifest_rows(old_stats, ASSETS, REPORT_TS)
    new = manifest_rows(new_stats, ASSETS, REPORT_TS)
    merged = in_rank_order(merge_manifest(old, new), "asset", ASSET_ORDER)
    return merged.withColumn("size_text", format_size_exact("db_size_bytes"))


# --- P16: JSON embedded in a text comment -------------------------------------------------------
@query("extract_embedded_json", sql=r"""
WITH n AS (
  SELECT conv_id, turn,
         text || CASE WHEN turn % 7 = 0 THEN ''
                      WHEN turn % 5 = 0 THEN chr(10) || '<!-- METADATA: {"conv":' || conv_id || ', -->'
                      ELSE chr(10) || '<!-- METADATA: ' || chr(10) || '{"conv":' || conv_id || ',"role":"' || role || '"}  -->' END AS notes
  FROM conversations),
b AS (SELECT conv_id, turn, regexp_extract(notes, '(?s)<!-- METADATA:\s*(\{.*?\})\s*-->', 1) AS body FROM n)
SELECT conv_id, turn,
       CASE WHEN body <> '' AND json_valid(body) THEN CAST(json_extract(body, '$.conv') AS BIGINT) END AS meta_conv,
       CASE WHEN body <> '' AND json_valid(body) THEN json_extract_string(body, '$.role') END AS meta_role
FROM b""")
def extract_embedded_json(spark, sf):
    """JSON read back from a metadata comment appended to each conversation turn."""
    conv = t(spark, sf, "conversations")
    nl = F.lit("\n")
    notes = F.concat(F.col("text"), F.when(F.col("turn") % 7 == 0, F.lit(""))
                     .when(F.col("turn") % 5 == 0,
                           F.concat(nl, F.lit('<!-- METADATA: {"conv":'),
                                    F.col("conv_id").cast("string"), F.lit(", -->")))
                     .otherwise(F.concat(nl, F.lit("<!-- METADATA: "), nl, F.lit('{"conv":'),
                                         F.col("conv_id").cast("string"), F.lit(',"role":"'),
                                         F.col("role"), F.lit('"}  -->'))))
    meta = conv.select("conv_id", "turn", embedded_json(notes).alias("m"))
    return meta.select("conv_id", "turn",
                       F.try_variant_get("m", "$.conv", "bigint").alias("meta_conv"),
                       F.try_variant_get("m", "$.role", "string").alias("meta_role"))
