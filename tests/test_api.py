"""Workflow calls: ingest -> enrich -> publish -> release manifest."""

import json
import os

from partsmith import api
from partsmith import schemas as S
from partsmith.streaming.catalog import Catalog
from tests.test_enrich import _vendor


def _write(path, obj):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(json.dumps(obj) + "\n")


def test_workflows_end_to_end(spark, scratch):
    _write(f"{scratch}/landing/p.json", {
        "dataList": [{"productCode": "C420", "productModel": "old", "brandNameEn": "Mine",
                      "stockNumber": 7},
                     {"productCode": "C5", "productModel": "x", "stockNumber": 1}],
        "currPage": 1, "totalRow": 2, "totalPage": 1})
    _write(f"{scratch}/tree/t.json", {"result": [
        {"categoryId": 1, "categoryNameEn": "Hardware", "childrenList": [
            {"categoryId": 2, "parentId": 1, "categoryNameEn": "Screws"}]}]})
    root = f"{scratch}/catalog"
    v1 = api.ingest(spark, f"{scratch}/landing", root, "2024-05-01 00:00:00",
                    category_tree=f"{scratch}/tree", category_root_path="$.result")
    catalog = Catalog(spark, root)
    assert {r.id: r.name_en for r in catalog.read("categories").collect()} == {
        1: "Hardware", 2: "Screws"}

    for name, df in zip(("components", "categories", "manufacturers"), _vendor(spark), strict=True):
        df.write.parquet(f"{scratch}/vendor/{name}")
    res = api.enrich(spark, root, f"{scratch}/vendor", "2024-05-02 00:00:00")
    assert res["version"] > v1 and res["affected"] == 1

    rows = {r.sku: r for r in catalog.read("products").collect()}
    assert rows["C420"].brand_name == "Mine" and rows["C420"].vendor_stock == 9000
    assert rows["C420"].mfr_part_number == "PH-M3x8" and rows["C5"].stock == 1
    names = {r.id: r.name_en for r in catalog.read("categories").collect()}
    assert names == {1: "Machine screws, pan head", 2: "Screws"}
    written = spark.read.parquet(f"{root}/products/v{res['version']:08d}")
    assert "merge_action" not in written.columns

    published = api.publish(spark, root, f"{scratch}/publish", ["search_only", "no_raw_json"])
    man = api.release_manifest(spark, published, "2024-05-02 00:00:00 UTC")
    got = {r.asset: r for r in man.collect()}
    assert set(got) == {"search_only", "no_raw_json"}
    assert all(r.db_size_bytes > 0 and r.db_size.endswith("B") for r in got.values())
    assert S.PRODUCT_KEY in spark.read.parquet(f"{scratch}/publish/search_only/search_docs").columns
    assert spark.read.parquet(f"{scratch}/publish/search_only/categories").count() == 2


def test_primary_dataset_and_archives(spark, scratch):
    _write(f"{scratch}/landing/p.json", {
        "dataList": [{"productCode": "C420", "productModel": "old", "brandNameEn": "Mine",
                      "stockNumber": 7}], "currPage": 1, "totalRow": 1, "totalPage": 1})
    root = f"{scratch}/catalog"
    api.ingest(spark, f"{scratch}/landing", root, buckets=4)
    assert Catalog(spark, root).state()["buckets"] == 4
    run = api.last_run(spark, root)
    updated = Catalog(spark, root).read("products").first().last_updated
    assert str(updated) == run and updated.microsecond == 0
    for name, df in zip(("components", "categories", "manufacturers"), _vendor(spark), strict=True):
        df.write.parquet(f"{scratch}/vendor/{name}")
    for _ in range(2):  # a second overlay doesn't become the primary dataset
        assert api.enrich(spark, root, f"{scratch}/vendor")["affected"] == 1

    def published(dataset):
        res = api.publish(spark, root, f"{scratch}/{dataset}", ["no_raw_json"], "uncompressed",
                          dataset, archive="zstd")
        rows = spark.read.parquet(res[0]["tables"]["products"]).collect()
        return res, {r.sku: (r.mfr_part_number, r.vendor_stock) for r in rows}

    primary, integrated = published("primary"), published("integrated")
    assert primary[1] == {"C420": ("old", 0)} and integrated[1]["C420"] == ("PH-M3x8", 9000)
    man = api.release_manifest(spark, integrated[0], "now").first()
    assert man.archive_size_bytes > 0 and man.db_size_bytes > 0
    Catalog(spark, root).vacuum(keep=1)
    assert published("primary")[1] == primary[1]


def test_publishing_again_replaces_whole_tables(spark, scratch):
    import os

    import pytest
    from pyspark.sql import functions as F

    from partsmith.operators.variants import write_tables

    df = spark.range(10).select(F.col("id"))
    write_tables({"t": df}, scratch)
    broken = df.select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        write_tables({"t": broken}, scratch)
    assert spark.read.parquet(f"{scratch}/t").count() == 10
    write_tables({"t": df.limit(3)}, scratch)
    assert spark.read.parquet(f"{scratch}/t").count() == 3
    assert not [n for n in os.listdir(scratch) if n.endswith(".old")]
