"""Variants, schema alignment, optional sources, codec option (FIXTURES §3)."""

import glob

import pytest

from partsmith import schemas as S
from partsmith.operators.align import align_schema, missing_columns
from partsmith.operators.variants import build_variant, generate_variants, selected_variants
from partsmith.sources.tables import read_optional
from tests.test_search import ROWS
from tests.helpers import products_df


def _base(spark):
    cats = spark.createDataFrame([(1, None, "Lighting", None, None),
                                  (2, None, "Portable", None, None)], S.CATEGORY_SCHEMA)
    return {"products": products_df(spark, ROWS), "categories": cats}


def test_search_only_variant(spark):
    v = build_variant(_base(spark), "search_only")
    assert set(v) == {"search_docs", "categories"}
    assert "raw_json" not in v["search_docs"].columns and len(v["search_docs"].columns) == 40
    assert v["categories"].count() == 2


def test_no_raw_json_variant(spark):
    v = build_variant(_base(spark), "no_raw_json")
    assert v["products"].filter("raw_json is not null").count() == 0
    assert v["products"].count() == 3


def test_unknown_variant_lists_choices(spark):
    with pytest.raises(ValueError, match="search_only"):
        build_variant(_base(spark), "nope")


def test_selection(spark):
    assert selected_variants(None) == ["search_only", "no_raw_json", "minimal"]
    assert selected_variants(["all"]) == ["search_only", "no_raw_json", "minimal"]
    assert selected_variants(["minimal"]) == ["minimal"]


def test_generate_selected_variants_written_with_codec(spark, scratch):
    res = generate_variants(_base(spark), scratch, ["search_only", "no_raw_json"])
    assert [r["variant"] for r in res] == ["search_only", "no_raw_json"]
    assert all(r["db_size_bytes"] > 0 for r in res)
    files = glob.glob(f"{scratch}/search_only/search_docs/*.parquet")
    assert files and all(".zstd." in f for f in files)
    back = spark.read.parquet(f"{scratch}/search_only/search_docs")
    assert back.count() == 3
    assert not glob.glob(f"{scratch}/search_only/products")


def test_align_schema_adds_missing_columns(spark):
    legacy = products_df(spark, ROWS).drop("raw_json", *S.VENDOR_COLUMNS)
    assert "raw_json" in missing_columns(legacy, S.PRODUCT_SCHEMA)
    out = align_schema(legacy, S.PRODUCT_SCHEMA, {"vendor_stock": 0})
    assert out.columns == S.PRODUCT_COLUMNS
    r = out.filter("sku = 'C11'").collect()[0]
    assert r.vendor_stock == 0 and r.raw_json is None and r.stock == 40


def test_optional_source_absent(spark, scratch):
    df = read_optional(spark, f"{scratch}/missing", S.CATEGORY_SCHEMA)
    assert df.count() == 0 and df.columns == S.CATEGORY_SCHEMA.fieldNames()
