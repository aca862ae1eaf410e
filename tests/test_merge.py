"""Merge properties: idempotence, order of input rows, last write wins,
child-row refresh across batches, counts; distributed ordering helpers."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from partsmith import schemas as S
from partsmith.operators.merge import (
    ACTION,
    COALESCE_TARGET,
    KEEP,
    dedupe_last_wins,
    merge,
    merge_stats,
    refresh_children,
)
from partsmith.operators.ordering import global_index
from partsmith.operators.progress import running_sum


def _t(spark):
    return spark.createDataFrame([("k1", 1, "a"), ("k2", 2, None), ("k3", 3, "c")],
                                 "k string, v long, s string")


def _s(spark, rows=None):
    rows = rows or [("k2", 20, "B", 1), ("k4", 40, "D", 2), ("k2", 21, None, 3)]
    return spark.createDataFrame(rows, "k string, v long, s string, seq long")


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def test_last_write_wins_and_rules(spark):
    out = {r.k: (r.v, r.s) for r in merge(_t(spark), _s(spark), ["k"],
                                         {"s": COALESCE_TARGET}, order_by=["seq"]).collect()}
    assert out == {"k1": (1, "a"), "k2": (21, None), "k3": (3, "c"), "k4": (40, "D")}
    out = {r.k: r.v for r in merge(_t(spark), _s(spark), ["k"], {"v": KEEP},
                                   order_by=["seq"]).collect()}
    assert out["k2"] == 2 and out["k4"] == 40


def test_merge_is_idempotent(spark):
    once = merge(_t(spark), _s(spark), ["k"], order_by=["seq"])
    twice = merge(once, _s(spark), ["k"], order_by=["seq"])
    assert _sorted(once) == _sorted(twice)


def test_input_order_is_irrelevant_given_the_order_column(spark):
    rows = [("k2", 20, "B", 1), ("k4", 40, "D", 2), ("k2", 21, None, 3), ("k4", 41, "E", 0)]
    a = merge(_t(spark), _s(spark, rows), ["k"], order_by=["seq"])
    shuffled = rows[:]
    random.Random(7).shuffle(shuffled)
    b = merge(_t(spark), _s(spark, shuffled).repartition(3), ["k"], order_by=["seq"])
    assert _sorted(a) == _sorted(b)


def test_dedupe_keeps_last(spark):
    d = dedupe_last_wins(_s(spark), ["k"], ["seq"])
    assert {r.k: r.v for r in d.collect()} == {"k2": 21, "k4": 40}


def test_stats(spark):
    m = merge(_t(spark), _s(spark), ["k"], order_by=["seq"], with_action=True)
    r = merge_stats(m).collect()[0]
    assert (r.inserted, r.updated, r.affected, r.unchanged, r.total_rows) == (1, 1, 2, 2, 4)
    assert set(x[ACTION] for x in m.collect()) == {"insert", "update", "unchanged"}


def test_children_refresh_last_batch_wins(spark):
    children = spark.createDataFrame([("a", "n", "old"), ("b", "n", "old"), ("c", "n", "old")],
                                     "sku string, param_name string, param_value string")
    parents = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("b", 2)],
                                    "sku string, batch int")
    new = spark.createDataFrame([("a", "x", "1", 1), ("a", "y", "2", 1), ("b", "z", "3", 1)],
                                "sku string, param_name string, param_value string, batch int")
    out = _sorted(refresh_children(children, parents, new, "sku", batch_col="batch"))
    # a: both rows of its (only) batch keep their params; b: last batch had none; c untouched
    assert out == [("a", "x", "1"), ("a", "y", "2"), ("c", "n", "old")]


def test_global_index_dense(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 7 % 1000).alias("v"))
    got = sorted((r.v, r.idx) for r in global_index(df, ["v"]).collect())
    assert got == [(i, i + 1) for i in range(1000)]


def test_running_sum_matches_window(spark):
    rows = [(r, i, (i * 37) % 11) for r in ("x", "y") for i in range(200)]
    df = spark.createDataFrame(rows, "run string, seq long, v long")
    w = Window.partitionBy("run").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    want = sorted((r.run, r.seq, r.s) for r in df.select("run", "seq", F.sum("v").over(w).alias("s")).collect())
    got = sorted((r.run, r.seq, r.running) for r in
                 running_sum(df, ["run"], ["seq"], "v", F.floor(F.col("seq") / 17)).collect())
    assert got == want


def test_product_schema_round_trip(spark):
    empty = spark.createDataFrame([], S.PRODUCT_SCHEMA)
    assert merge(empty, empty, ["sku"], source_is_unique=True).columns == S.PRODUCT_COLUMNS


def test_bucketed_target_is_not_shuffled(spark, scratch):
    from partsmith.operators.merge import write_keyed_table

    parts = spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    rows = [(f"k{i}", i, "x") for i in range(200)]
    target = spark.createDataFrame(rows, "k string, v long, s string")
    write_keyed_table(target, "t_bucketed_merge", ["k"], parts, f"{scratch}/t")
    src = _s(spark, [("k5", 50, "y", 1), ("k500", 5, "z", 2)])
    bucketed = merge(spark.table("t_bucketed_merge"), src, ["k"], order_by=["seq"])
    plain = merge(target, src, ["k"], order_by=["seq"])
    assert _sorted(bucketed) == _sorted(plain)
    plan = bucketed._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1  # only the batch side


def test_sources_must_be_ordered_or_unique(spark):
    import pytest

    t = spark.createDataFrame([("k1", 1)], "k string, v long")
    twice = spark.createDataFrame([("k1", 2), ("k1", 3)], "k string, v long")
    with pytest.raises(ValueError, match="order_by"):
        merge(t, twice, ["k"])
    with pytest.raises(Exception, match="repeated key"):
        merge(t, twice, ["k"], source_is_unique=True).collect()
    assert _sorted(merge(t, twice.limit(1), ["k"], source_is_unique=True)) == [("k1", 2)]
