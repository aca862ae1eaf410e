"""Partition planner (FIXTURES §5)."""

from partsmith import schemas as S
from partsmith.operators.planner import partition_plan, union_dedupe


def _items(spark, rows):
    return spark.createDataFrame(rows, "category long, brand string, name string")


def test_split_by_brand(spark):
    rows = [(7, "1001" if i < 50 else "1002", f"part{i}") for i in range(100)]
    plan = partition_plan(_items(spark, rows), "category", "brand", "name", threshold=100)
    got = sorted((r.brand, r.keyword, r.row_count, r.oversize) for r in plan.collect())
    assert got == [("1001", None, 50, False), ("1002", None, 50, False)]


def test_no_brands_split_by_character_and_flag(spark):
    name = S.PARTITION_CHARS  # every character occurs in every row
    rows = [(3, None, name) for _ in range(200)]
    plan = partition_plan(_items(spark, rows), "category", "brand", "name", threshold=100).collect()
    assert len(plan) == 36
    assert all(r.brand is None and r.row_count == 200 and r.oversize for r in plan)
    assert sorted(r.keyword for r in plan) == sorted(S.PARTITION_CHARS)


def test_small_categories_whole_and_known_zero_skipped(spark):
    rows = [(1, "b", "x")] * 3 + [(2, "b", "y")] * 2
    known = spark.createDataFrame([(2, 0)], "category long, product_num long")
    plan = partition_plan(_items(spark, rows), "category", "brand", "name", threshold=10,
                          known_counts=known).collect()
    assert [(r.category, r.brand, r.keyword, r.row_count) for r in plan] == [(1, None, None, 3)]


def test_brand_then_character(spark):
    rows = [(1, "big", f"a{i}") for i in range(12)] + [(1, "small", "zz")] * 2
    plan = partition_plan(_items(spark, rows), "category", "brand", "name", threshold=10)
    got = {(r.brand, r.keyword): (r.row_count, r.oversize) for r in plan.collect()}
    assert got[("small", None)] == (2, False)
    assert got[("big", "a")] == (12, True)
    assert got[("big", "1")] == (3, False)  # a1, a10, a11


def test_union_dedupe(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k long, v string")
    b = spark.createDataFrame([(2, "y"), (3, "z")], "k long, v string")
    assert sorted(r.k for r in union_dedupe([a, b], ["k"]).collect()) == [1, 2, 3]


def test_parts_cover_every_row(spark):
    """Rows without a brand, without a listed character and without a category are in parts."""
    from partsmith.operators.planner import assign_parts

    rows = ([(1, "big", f"a{i}") for i in range(12)] + [(1, "small", "zz")] * 2
            + [(1, None, "--")] * 3 + [(2, "b", "x")] * 9 + [(2, None, "b1")] * 11
            + [(2, None, "##")] * 2 + [(3, None, "?")] * 10 + [(4, None, "q")] * 2
            + [(None, "n", "y")] * 3 + [(5, "w", "!!")] * 10)
    items = _items(spark, rows)
    plan = {(r.category, r.brand, r.keyword, r.rest): (r.row_count, r.oversize)
            for r in partition_plan(items, "category", "brand", "name", threshold=10).collect()}
    assert plan[(1, None, None, "no brand")] == (3, False)
    assert plan[(2, "b", None, None)] == (9, False)
    assert plan[(2, None, "b", "no brand")] == (11, True)
    assert plan[(2, None, None, "no brand, no character")] == (2, False)
    assert plan[(3, None, None, "no character")] == (10, True)
    assert plan[(4, None, None, None)] == (2, False) and plan[(None, None, None, None)] == (3, False)
    assert plan[(5, "w", None, "no character")] == (10, True)
    placed = assign_parts(items, "category", "brand", "name", threshold=10).collect()
    got = {}
    for r in placed:
        key = (r.category, r.part_brand, r.part_keyword, r.part_rest)
        got[key] = got.get(key, 0) + 1
    assert got == {k: n for k, (n, _) in plan.items()}
    assert {(r.category, r.brand, r.name) for r in placed} == set(rows)


def test_nothing_to_plan(spark):
    none = _items(spark, [(1, "b", "x")]).limit(0)
    assert partition_plan(none, "category", "brand", "name").collect() == []
