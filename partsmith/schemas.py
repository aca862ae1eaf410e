"""Canonical table schemas, API key aliases and merge policies.

Everything in the "fixed values" blocks must stay as written: the key names are
the ones the upstream product API sends, and the column lists define which
columns a search matches and which are carried along.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Canonical ``products`` table.  (name, type, nullable)
# ---------------------------------------------------------------------------
PRODUCT_FIELDS: list[tuple[str, T.DataType, bool]] = [
    ("sku", T.StringType(), False),
    ("mfr_part_number", T.StringType(), False),
    ("brand_id", T.LongType(), True),
    ("brand_name", T.StringType(), True),
    ("package", T.StringType(), True),
    ("description", T.StringType(), True),
    ("category_id", T.LongType(), True),
    ("first_category_name", T.StringType(), True),
    ("second_category_name", T.StringType(), True),
    ("third_category_name", T.StringType(), True),
    ("stock", T.LongType(), True),
    ("stock_sz", T.LongType(), True),
    ("stock_js", T.LongType(), True),
    ("stock_hk", T.LongType(), True),
    ("moq", T.LongType(), True),
    ("spq", T.LongType(), True),
    ("min_packet_number", T.LongType(), True),
    ("min_packet_unit", T.StringType(), True),
    ("product_unit", T.StringType(), True),
    ("product_arrange", T.StringType(), True),
    ("price_ladder", T.StringType(), True),
    ("pdf_url", T.StringType(), True),
    ("image_url", T.StringType(), True),
    ("product_images", T.StringType(), True),
    ("msl", T.StringType(), True),
    ("eccn", T.StringType(), True),
    ("url", T.StringType(), True),
    ("is_rohs", T.LongType(), True),
    ("is_hot", T.LongType(), True),
    ("is_reel", T.LongType(), True),
    ("reel_price", T.DoubleType(), True),
    ("is_sample", T.LongType(), True),
    ("is_discount", T.LongType(), True),
    ("is_pre_sale", T.LongType(), True),
    ("vendor_stock", T.LongType(), True),
    ("vendor_price_ladder", T.StringType(), True),
    ("vendor_library_type", T.StringType(), True),
    ("vendor_extra", T.StringType(), True),
    ("vendor_last_updated", T.TimestampNTZType(), True),
    ("last_updated", T.TimestampNTZType(), True),
    ("raw_json", T.StringType(), True),
]

PRODUCT_SCHEMA = T.StructType([T.StructField(n, t, nl) for n, t, nl in PRODUCT_FIELDS])
PRODUCT_COLUMNS = [n for n, _, _ in PRODUCT_FIELDS]
PRODUCT_KEY = "sku"

# --- fixed values: search layout -------------------------------------------
# The eight columns a substring search matches, in this order.
SEARCH_INDEXED_COLUMNS = [
    "sku",
    "mfr_part_number",
    "brand_name",
    "package",
    "description",
    "first_category_name",
    "second_category_name",
    "third_category_name",
]
# The search table carries every product column except the raw document.
SEARCH_COLUMNS = [c for c in PRODUCT_COLUMNS if c != "raw_json"]

# --- fixed values: stock columns (zeroed when a run no longer sees a product) and the second
# vendor's columns -------------------------------------------------------------
STOCK_COLUMNS = ["stock", "stock_sz", "stock_js", "stock_hk"]
VENDOR_COLUMNS = [
    "vendor_stock",
    "vendor_price_ladder",
    "vendor_library_type",
    "vendor_extra",
    "vendor_last_updated",
]
# Descriptive columns the vendor overlay fills only where the catalog has none.
OVERLAY_FILL_COLUMNS = [
    "brand_id",
    "brand_name",
    "package",
    "description",
    "category_id",
    "first_category_name",
    "second_category_name",
    "pdf_url",
]

# --- fixed values: API document keys -> canonical columns ------------------
# Product documents name fields in camelCase; a column without an explicit
# alias below is sent under the camelCase form of its own name.
PRODUCT_KEY_ALIASES: dict[str, str] = {
    "sku": "productCode",
    "mfr_part_number": "productModel",
    "brand_name": "brandNameEn",
    "package": "encapStandard",
    "description": "productIntroEn",
    "first_category_name": "firstWmCatalogNameEn",
    "second_category_name": "secondWmCatalogNameEn",
    "third_category_name": "thirdWmCatalogNameEn",
    "stock": "stockNumber",
    "stock_hk": "wmStockHk",
    "moq": "minBuyNumber",
    "spq": "split",
    "price_ladder": "productPriceList",
    "image_url": "productImageUrl",
    "msl": "moistureSensitivityLevel",
    "is_rohs": "isEnvironment",
}
# Document-only keys (not columns of their own).
DOC_PRODUCT_ID = "productId"
DOC_CATALOG_ID = "catalogId"
DOC_WM_CATALOG_ID = "wmCatalogId"
DOC_PARAMS = "paramVOList"
# Key columns a document must not send as an explicit null.
REQUIRED_DOC_STRINGS = ["sku", "mfr_part_number"]
PARAM_KEYS = ["paramNameEn", "paramName", "paramValueEn", "paramValue"]
PRICE_KEYS = ["ladder", "usdPrice"]

# --- fixed values: falsy defaults applied when a document becomes a row ------
# ``x or d``: a missing *or zero* value becomes d.
FALSY_DEFAULTS: dict[str, object] = {
    "stock": 0,
    "stock_sz": 0,
    "stock_js": 0,
    "stock_hk": 0,
    "moq": 1,
    "spq": 1,
    "reel_price": 0.0,
}
FLAG_COLUMNS = ["is_rohs", "is_hot", "is_reel", "is_sample", "is_discount", "is_pre_sale"]

# --- fixed values: vendor library tier labels ------------------------------
TIER_BASIC = "Basic"
TIER_PREFERRED = "Preferred"
TIER_EXTENDED = "Extended"

# --- fixed values: partition planner ---------------------------------------
PARTITION_THRESHOLD = 5000
PARTITION_CHARS = "0123456789abcdefghijklmnopqrstuvwxyz"
PAGE_SIZE = 100


def camel(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(p[:1].upper() + p[1:] for p in rest)


def doc_key(column: str) -> str:
    """API key under which a canonical product column arrives in a document."""
    return PRODUCT_KEY_ALIASES.get(column, camel(column))


# ---------------------------------------------------------------------------
# Other canonical tables
# ---------------------------------------------------------------------------
CATEGORY_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("parent_id", T.LongType(), True),
    T.StructField("name_en", T.StringType(), False),
    T.StructField("name_cn", T.StringType(), True),
    T.StructField("code", T.StringType(), True),
])

PARAM_SCHEMA = T.StructType([
    T.StructField("sku", T.StringType(), True),
    T.StructField("param_name", T.StringType(), True),
    T.StructField("param_value", T.StringType(), True),
])

# Second vendor's bulk tables.
VENDOR_COMPONENT_SCHEMA = T.StructType([
    T.StructField("part_code", T.LongType(), False),
    T.StructField("category_id", T.LongType(), False),
    T.StructField("mfr", T.StringType(), False),
    T.StructField("package", T.StringType(), False),
    T.StructField("joints", T.LongType(), False),
    T.StructField("manufacturer_id", T.LongType(), False),
    T.StructField("basic", T.LongType(), False),
    T.StructField("description", T.StringType(), False),
    T.StructField("datasheet", T.StringType(), False),
    T.StructField("stock", T.LongType(), False),
    T.StructField("price", T.StringType(), False),
    T.StructField("last_update", T.LongType(), False),
    T.StructField("extra", T.StringType(), True),
    T.StructField("flag", T.LongType(), True),
    T.StructField("last_on_stock", T.LongType(), True),
    T.StructField("preferred", T.LongType(), True),
])
VENDOR_CATEGORY_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("category", T.StringType(), False),
    T.StructField("subcategory", T.StringType(), False),
])
VENDOR_MANUFACTURER_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("name", T.StringType(), False),
])

MANIFEST_SCHEMA = T.StructType([
    T.StructField("asset", T.StringType(), False),
    T.StructField("variant", T.StringType(), True),
    T.StructField("archive_name", T.StringType(), True),
    T.StructField("description", T.StringType(), True),
    T.StructField("db_size_bytes", T.LongType(), True),
    T.StructField("archive_size_bytes", T.LongType(), True),
    T.StructField("last_updated", T.StringType(), True),
])
