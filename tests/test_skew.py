"""A third of all rows on one key: results stay exact and the hot key is
reduced map-side (partial aggregation), never funnelled through a window."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from partsmith.operators.merge import dedupe_last_wins, merge
from partsmith.operators.progress import running_sum
from partsmith.operators.search import facet_counts
from partsmith.operators.tree import rollup_counts, tree_paths

N = 30000


def _skewed(spark):
    # rows 0..9999 share key "hot"; the rest have their own key
    return spark.range(0, N, 1, 8).select(
        F.when(F.col("id") < N // 3, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"),
        F.col("id").alias("seq"), (F.col("id") * 3).alias("v"))


def test_dedupe_hot_key_is_exact_and_pre_aggregated(spark):
    d = dedupe_last_wins(_skewed(spark), ["k"], ["seq"])
    hot = d.filter("k = 'hot'").collect()
    assert len(hot) == 1 and hot[0].seq == N // 3 - 1 and hot[0].v == 3 * (N // 3 - 1)
    assert d.count() == N - N // 3 + 1
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def test_merge_with_hot_batch_key(spark):
    target = spark.createDataFrame([("hot", 0, 0), ("cold", 1, 1)], "k string, seq long, v long")
    out = {r.k: r.v for r in merge(target.drop("seq"), _skewed(spark), ["k"], order_by=["seq"]).collect()}
    assert out["hot"] == 3 * (N // 3 - 1) and out["cold"] == 1 and len(out) == N - N // 3 + 2


def test_facet_and_rollup_with_dominant_value(spark):
    rows = _skewed(spark).withColumn("brand", F.when(F.col("k") == "hot", "big").otherwise("small"))
    f = {r.brand: (r.n, r.total_count) for r in facet_counts(rows, "brand").collect()}
    assert f == {"big": (N // 3, N), "small": (N - N // 3, N)}
    nodes = spark.createDataFrame([(1, None, "root", None, None), (2, 1, "a", None, None),
                                   (3, 1, "b", None, None)],
                                  "id long, parent_id long, name_en string, name_cn string, code string")
    items = _skewed(spark).select(F.when(F.col("k") == "hot", 2).otherwise(3).alias("category_id"))
    got = {r.id: r.product_num for r in rollup_counts(tree_paths(nodes), items, "category_id").collect()}
    assert got == {1: N, 2: N // 3, 3: N - N // 3}


def test_running_sum_of_a_dominant_run(spark):
    df = _skewed(spark).select(F.when(F.col("k") == "hot", "hot").otherwise("rest").alias("run"),
                               "seq", "v")
    w = Window.partitionBy("run").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    want = {(r.run, r.seq): r.s for r in df.select("run", "seq", F.sum("v").over(w).alias("s")).collect()}
    got = {(r.run, r.seq): r.running for r in
           running_sum(df, ["run"], ["seq"], "v", F.floor(F.col("seq") / 1000)).collect()}
    assert got == want


def test_running_sum_of_a_run_within_one_hour_spreads(spark):
    """One run, all of it in the same minute: segments are sampled, so many tasks share it."""
    from partsmith.operators.progress import _segments

    df = spark.range(0, N, 1, 6).select(F.lit("run").alias("run"), F.col("id").alias("seq"),
                                        (F.col("id") % 5).alias("v"),
                                        F.timestamp_seconds(F.col("id") / 1000).alias("ts"))
    parts = [r[1] for r in _segments(df, ["run"], ["ts", "seq"]).groupBy("__chunk").count().collect()]
    assert len(parts) >= 3 and max(parts) < 0.6 * N
    w = Window.partitionBy("run").orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, 0)
    want = {r.seq: r.s for r in df.select("seq", F.sum("v").over(w).alias("s")).collect()}
    got = {r.seq: r.running for r in running_sum(df, ["run"], ["ts", "seq"], "v").collect()}
    assert got == want


def test_running_sum_with_null_runs_and_values(spark):
    df = spark.createDataFrame([(None, 1, 2), (None, 2, None), ("a", 1, None), ("a", 2, 4)],
                               "run string, seq int, v long")
    got = sorted((r.run or "", r.seq, r.running) for r in running_sum(df, ["run"], ["seq"], "v").collect())
    assert got == [("", 1, 2), ("", 2, 2), ("a", 1, 0), ("a", 2, 4)]
