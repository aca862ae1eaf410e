"""Formatting, embedded metadata, size reports and manifest merge (FIXTURES §7)."""

import json

from pyspark.sql import functions as F

from partsmith.functions.formatting import embedded_json, format_duration, signed_pct
from partsmith.operators.report import (
    compare_to_baseline,
    format_size_exact,
    merge_manifest,
    ranked,
    table_stats,
)


def _one(spark, expr, value, dtype="long"):
    return spark.createDataFrame([(value,)], f"x {dtype}").select(expr(F.col("x"))).collect()[0][0]


def test_durations(spark):
    assert [_one(spark, format_duration, v) for v in (5, 65, 3665, -4)] == \
        ["5s", "1m 05s", "1h 01m 05s", "0s"]
    assert _one(spark, format_duration, 65.9, "double") == "1m 05s"


def test_sizes(spark):
    cases = [(None, "N/A"), (500, "500 B"), (2048, "2.00 KB"), (10 * 1024 ** 2, "10.00 MB"),
             (2 * 1024 ** 3, "2.00 GB"), (1152, "1.12 KB"), (1160, "1.13 KB")]
    for v, want in cases:
        assert _one(spark, format_size_exact, v) == want


def test_signed_pct(spark):
    assert _one(spark, signed_pct, 12.5, "double") == "+12.5%"
    assert _one(spark, signed_pct, -3.0, "double") == "-3.0%"


def test_notes_metadata_round_trip(spark):
    meta = {"a.db": {"db_size_bytes": 100 * 1024 ** 2, "archive_size_bytes": 20 * 1024 ** 2},
            "b.db": {"db_size_bytes": 50 * 1024 ** 2, "archive_size_bytes": 10 * 1024 ** 2}}
    notes = "Release.\n| table |\n\n<!-- METADATA: " + json.dumps(meta) + " -->\ntrailer {x}"
    df = spark.createDataFrame([(notes,), ("no comment",), ("<!-- METADATA: {bad -->",)], "n string")
    got = [r[0] for r in df.select(F.to_json(embedded_json("n"))).collect()]
    assert json.loads(got[0]) == meta and got[1] is None and got[2] is None


def test_report_against_baseline_and_order(spark):
    base = spark.createDataFrame([("a", "xxxx"), ("b", "yy")], "k string, v string")
    stats = table_stats("catalog", base).unionByName(table_stats("catalog_search", base.select("k")))
    out = {r.name: r for r in ranked(compare_to_baseline(stats, "catalog"), "name",
                                     ["catalog_search", "catalog"]).collect()}
    assert out["catalog"].logical_bytes == 8 and out["catalog_search"].logical_bytes == 2
    assert out["catalog_search"].pct_vs_base == -75.0 and out["catalog"].pct_vs_base == 0.0
    assert out["catalog_search"].rank == 0 and out["catalog"].rank == 1


def test_manifest_merge_replaces_by_asset(spark):
    schema = ("asset string, variant string, archive_name string, description string, "
              "db_size_bytes long, archive_size_bytes long, last_updated string")
    old = spark.createDataFrame([("a", "A", "a.tar.xz", "d", 1, 1, "t0"),
                                 ("b", "B", "b.tar.xz", "d", 2, 2, "t0")], schema)
    new = spark.createDataFrame([("b", "B", "b.tar.xz", "d", 20, None, "t1"),
                                 ("c", "C", "c.tar.xz", "d", 3, 3, "t1")], schema)
    got = {r.asset: (r.db_size_bytes, r.last_updated) for r in merge_manifest(old, new).collect()}
    assert got == {"a": (1, "t0"), "b": (20, "t1"), "c": (3, "t1")}
