"""Vendor table readers, file statistics and the single-category run."""

from partsmith import schemas as S
from partsmith.operators.report import file_bytes
from partsmith.operators.tree import single_category_work_list
from partsmith.operators.variants import write_tables
from partsmith.sources.vendor import read_vendor_tables
from tests.test_enrich import _vendor


def test_vendor_tables_round_trip_parquet_and_csv(spark, scratch):
    comps, cats, mfrs = _vendor(spark)
    for name, df in (("components", comps), ("categories", cats), ("manufacturers", mfrs)):
        df.write.parquet(f"{scratch}/pq/{name}")
        df.write.option("header", "true").csv(f"{scratch}/csv/{name}")
    for fmt, base in (("parquet", f"{scratch}/pq"), ("csv", f"{scratch}/csv")):
        t = read_vendor_tables(spark, base, fmt)
        got = [(f.name, f.dataType) for f in t["components"].schema.fields]
        assert got == [(f.name, f.dataType) for f in S.VENDOR_COMPONENT_SCHEMA.fields]
        assert t["components"].collect()[0].part_code == 420
        assert t["manufacturers"].collect()[0].name == "Ostra"


def test_file_bytes_of_written_tables(spark, scratch):
    comps, _, _ = _vendor(spark)
    write_tables({"components": comps}, scratch)
    r = file_bytes(spark, f"{scratch}/components").collect()[0]
    assert r.files >= 1 and r.bytes > 0


def test_single_category_run(spark):
    r = single_category_work_list(spark, 77).collect()
    assert [(x.id, x.path, x.product_num, x.cat_idx, x.total_cats) for x in r] == \
        [(77, "Category #77", None, 1, 1)]


def test_optional_table_by_uri_and_path(spark, scratch):
    from partsmith.sources.tables import read_optional

    spark.range(3).write.parquet(f"{scratch}/cats")
    for path in (f"{scratch}/cats", f"file:{scratch}/cats", f"file://{scratch}/cats"):
        assert read_optional(spark, path, spark.range(1).schema).count() == 3
    assert read_optional(spark, f"file:{scratch}/none", spark.range(1).schema).count() == 0
