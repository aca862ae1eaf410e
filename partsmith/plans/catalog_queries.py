"""Catalog query surface: substring search, top-k, key lookup, filters,
paging and facets (over ``part``, ``customer``, ``documents``, ``pages``)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from partsmith.operators.search import (
    catalog_filter,
    facet_counts,
    page_envelope,
    search,
    top_k,
)
from partsmith.plans.bindings import (
    CUSTOMER_PRODUCTS_SQL,
    PART_PRODUCTS_SQL,
    products_from_customer,
    products_from_part,
    t,
)
from partsmith.operators.variants import write_tables
from partsmith.plans.registry import query
from partsmith.session import scratch_path
from partsmith.plans.sqlbits import any_col_contains

# fixed values: the demo terms of the registered queries
FLAGSHIP_TERM = "widget"
DOC_TERM = "the"
PAGE_ALL = ["example", "zz", "http"]        # "zz" is too short for trigrams: ignored
PAGE_ANY = ["/en/", "/de/"]
PAGE_NONE = ["nicht"]
LOOKUP_KEY = "C1234"


# --- F5 + T1 + P20: the flagship "search, order by stock, top 20" -----------
def flagship(products):
    hits = search(products, all=[FLAGSHIP_TERM])
    return top_k(hits, 20, [F.col("stock").desc()], tie_break=["sku"]).select(
        "sku", "mfr_part_number", "brand_name", "package", "description",
        F.col("stock").alias("catalog_stock"), "vendor_stock", "vendor_library_type",
        "pdf_url")


@query("search_topk", sql=f"""
WITH p AS ({PART_PRODUCTS_SQL})
SELECT sku, mfr_part_number, brand_name, package, description, stock AS catalog_stock,
       vendor_stock, vendor_library_type, pdf_url
FROM p WHERE {any_col_contains(FLAGSHIP_TERM)}
ORDER BY stock DESC, sku LIMIT 20""")
def search_topk(spark, sf):
    """Substring search for the flagship term over the indexed columns of ``part`` as
    products, top 20 by stock (ties by key)."""
    return flagship(products_from_part(t(spark, sf, "part")))


# --- F5 over one long text column ---------------------------------------------
@query("trigram_search", sql=f"""
SELECT doc_id, lang FROM documents WHERE {any_col_contains(DOC_TERM, ['text'])}""")
def trigram_search(spark, sf):
    """Scan path of the trigram search: the index's matching rule (case-folded
    substring, terms of at least three characters) applied to every document."""
    docs = t(spark, sf, "documents")
    return search(docs, all=[DOC_TERM], columns=["text"]).select("doc_id", "lang")


# --- F5 with all / any / none across two columns -------------------------------
@query("search_multi_term", sql=f"""
SELECT page_id, url FROM pages
WHERE {any_col_contains('example', ['url', 'html'])}
  AND {any_col_contains('http', ['url', 'html'])}
  AND ({any_col_contains('/en/', ['url', 'html'])} OR {any_col_contains('/de/', ['url', 'html'])})
  AND NOT {any_col_contains('nicht', ['url', 'html'])}""")
def search_multi_term(spark, sf):
    """Search over ``pages`` url and html: every ``all`` term, at least one ``any`` term,
    no ``none`` term; a too-short term is ignored."""
    pages = t(spark, sf, "pages")
    return search(pages, all=PAGE_ALL, any=PAGE_ANY, none=PAGE_NONE,
                  columns=["url", "html"]).select("page_id", "url")


# --- F3: exact key lookup --------------------------------------------------------
@query("key_lookup", sql=f"""
WITH p AS ({PART_PRODUCTS_SQL})
SELECT sku, mfr_part_number, brand_name, package, description, stock, pdf_url
FROM p WHERE sku = '{LOOKUP_KEY}'""")
def key_lookup(spark, sf):
    """Exact, case-sensitive lookup of one key in a stored catalog sorted by it."""
    path = scratch_path(spark, "catalog")
    write_tables({"products": products_from_part(t(spark, sf, "part"))}, path)
    p = spark.read.parquet(f"{path}/products")
    return p.filter(F.col("sku") == LOOKUP_KEY).select(
        "sku", "mfr_part_number", "brand_name", "package", "description", "stock", "pdf_url")


# --- K1 + F3: lookup by value in an unsorted copy, served by Bloom filters ------------
@query("bloom_lookup", sql=f"""
WITH p AS ({PART_PRODUCTS_SQL})
SELECT sku, mfr_part_number, brand_name, stock FROM p
WHERE mfr_part_number = (SELECT p_name FROM part WHERE 'C' || p_partkey = '{LOOKUP_KEY}')""")
def bloom_lookup(spark, sf):
    """All products of one part number, looked up in a copy that is sorted by nothing."""
    path = scratch_path(spark, "catalog")
    write_tables({"products": products_from_part(t(spark, sf, "part"))}, path, sort_keys={})
    p = spark.read.parquet(f"{path}/products")
    wanted = p.filter(F.col("sku") == LOOKUP_KEY).select("mfr_part_number").first()
    return p.filter(F.col("mfr_part_number") == (wanted[0] if wanted else None)).select(
        "sku", "mfr_part_number", "brand_name", "stock")


# --- F4 + T1: tier IN-list and stock threshold, top 20 ----------------------------
@query("tier_and_stock_topk", sql=f"""
WITH p AS ({CUSTOMER_PRODUCTS_SQL})
SELECT sku, mfr_part_number, brand_name, description, vendor_stock, vendor_library_type
FROM p WHERE vendor_library_type IN ('Basic', 'Preferred') AND vendor_stock > 1000
ORDER BY vendor_stock DESC, sku LIMIT 20""")
def tier_and_stock_topk(spark, sf):
    """Tier IN-list and vendor stock threshold over ``customer`` as products, top 20 by
    vendor stock."""
    p = products_from_customer(t(spark, sf, "customer"))
    hits = p.filter(F.col("vendor_library_type").isin("Basic", "Preferred")
                    & (F.col("vendor_stock") > 1000))
    return top_k(hits, 20, [F.col("vendor_stock").desc()], tie_break=["sku"]).select(
        "sku", "mfr_part_number", "brand_name", "description", "vendor_stock",
        "vendor_library_type")


# --- F1: composite filter (category IN, brand IN, in stock, keyword) ----------------
@query("catalog_filter", sql=f"""
WITH p AS ({CUSTOMER_PRODUCTS_SQL})
SELECT sku, category_id, brand_name, stock FROM p
WHERE category_id IN (1, 3, 5, 7, 11, 13) AND brand_name IN ('BUILDING', 'MACHINERY')
  AND stock > 0 AND {any_col_contains('customer#00000')}""")
def catalog_filter_q(spark, sf):
    """Composite filter: categories IN, brands IN, in stock, keyword substring."""
    p = products_from_customer(t(spark, sf, "customer"))
    return catalog_filter(p, category_ids=[1, 3, 5, 7, 11, 13],
                          brand_ids=["BUILDING", "MACHINERY"], brand_col="brand_name",
                          instock_only=True, keyword="Customer#00000").select(
        "sku", "category_id", "brand_name", "stock")


# --- F2: one id, a list, an empty list, no argument -------------------------------------
@query("id_filters", sql=f"""
WITH p AS ({CUSTOMER_PRODUCTS_SQL})
SELECT 'one' AS asked, sku, category_id FROM p WHERE category_id = 7
UNION ALL SELECT 'list', sku, category_id FROM p WHERE category_id IN (3, 11)
UNION ALL SELECT 'none given', sku, category_id FROM p""")
def id_filters(spark, sf):
    """Category filter by a single id, a list, an empty list (matches nothing) and without."""
    p = products_from_customer(t(spark, sf, "customer"))
    asked = {"one": 7, "list": [3, 11], "empty": [], "none given": None}
    return reduce(lambda a, b: a.unionByName(b), [
        catalog_filter(p, category_ids=ids).select(F.lit(name).alias("asked"), "sku", "category_id")
        for name, ids in asked.items()])


# --- T2 + A5: page 3 of 100 with the page envelope --------------------------------
@query("paged_query", sql=f"""
WITH p AS ({CUSTOMER_PRODUCTS_SQL}), f AS (SELECT * FROM p WHERE stock > 0)
SELECT sku, stock,
       (SELECT count(*) FROM f) AS total_row,
       CAST(((SELECT count(*) FROM f) + 99) // 100 AS BIGINT) AS total_page,
       CAST(3 AS BIGINT) AS curr_page
FROM f ORDER BY sku LIMIT 100 OFFSET 200""")
def paged_query(spark, sf):
    """Page 3 (100 rows, ordered by key) of the in-stock products with the page envelope."""
    p = catalog_filter(products_from_customer(t(spark, sf, "customer")), instock_only=True)
    return page_envelope(p.select("sku", "stock"), 3, 100, order=["sku"]).select(
        "sku", "stock", "total_row", "total_page", "curr_page")


# --- A6: brand facet under a filter ---------------------------------------------
@query("facet_brand_counts", sql=f"""
WITH p AS ({CUSTOMER_PRODUCTS_SQL}), f AS (SELECT * FROM p WHERE category_id IN (0, 1, 2, 3, 4, 5, 6, 7, 8, 9) AND stock > 0)
SELECT brand_name, count(*) AS n, (SELECT count(*) FROM f) AS total_count
FROM f WHERE brand_name IS NOT NULL GROUP BY brand_name""")
def facet_brand_counts(spark, sf):
    """Brand counts under a category + in-stock filter, with the filter's total."""
    p = catalog_filter(products_from_customer(t(spark, sf, "customer")),
                       category_ids=list(range(10)), instock_only=True)
    return facet_counts(p, "brand_name").select("brand_name", "n", "total_count")
