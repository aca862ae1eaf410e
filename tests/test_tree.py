"""Category trees: unrolling nested documents, leaves, breadcrumbs, counts,
work list fallback (FIXTURES §4)."""

import json

from partsmith import schemas as S
from partsmith.operators.tree import (
    flatten,
    leaf_paths,
    name_en_cn_id,
    rollup_counts,
    tree_paths,
    work_list,
)
from partsmith.sources.trees import (
    CATALOG_NODE,
    breadcrumb_leaves,
    category_records,
    label_en_id,
    unroll_tree,
)

TREE = [{"categoryId": 10, "categoryNameEn": "Tools", "childrenList": [
    {"categoryId": 11, "parentId": 10, "categoryNameEn": "Saws"},
    {"categoryId": 12, "parentId": 10, "categoryNameEn": "", "categoryNameCn": "锤子"}]}]
CATALOG = [{"catalogId": 10, "catalogNameEn": "Tools", "productNum": 9}]


def _doc(spark, obj):
    return spark.createDataFrame([(json.dumps(obj, ensure_ascii=False),)], "doc string")


def test_unroll_every_node_preorder(spark):
    nodes = unroll_tree(_doc(spark, TREE))
    recs = category_records(nodes).orderBy("path_key").collect()
    assert [r.id for r in recs] == [10, 11, 12]
    assert recs[1].parent_id == 10 and recs[2].name_en == ""


def test_leaf_breadcrumbs_use_leaves_only(spark):
    leaves = breadcrumb_leaves(unroll_tree(_doc(spark, TREE))).orderBy("path_key").collect()
    assert [(r.id, r.path) for r in leaves] == [(11, "Tools > Saws"),
                                               (12, "Tools > 锤子")]


def test_catalog_expected_total(spark):
    cats = [{"catalogId": 1, "catalogNameEn": "Saws", "productNum": 30},
            {"catalogId": 2, "catalogNameEn": "Clamps", "productNum": 12},
            {"catalogId": 0, "catalogNameEn": "zero id", "productNum": 5}]
    leaves = breadcrumb_leaves(unroll_tree(_doc(spark, cats), CATALOG_NODE), label_en_id)
    assert leaves.agg({"product_num": "sum"}).collect()[0][0] == 42
    assert sorted(r.id for r in leaves.collect()) == [1, 2]


def _adjacency(spark):
    rows = [(1, None, "Root", None, None), (2, 1, "A", None, None), (3, 1, "", "B-cn", None),
            (4, 2, "A1", None, None), (5, 2, "", None, None)]
    return spark.createDataFrame(rows, S.CATEGORY_SCHEMA)


def test_flatten_preorder_positions(spark):
    got = [(r.id, r.depth, r.preorder_pos) for r in
           flatten(_adjacency(spark)).orderBy("preorder_pos").collect()]
    assert got == [(1, 0, 1), (2, 1, 2), (4, 2, 3), (5, 2, 4), (3, 1, 5)]


def test_leaf_paths_name_fallback(spark):
    got = {r.id: r.path for r in leaf_paths(_adjacency(spark), name_en_cn_id()).collect()}
    assert got == {4: "Root > A > A1", 5: "Root > A > 5", 3: "Root > B-cn"}


def test_rollup_counts_cover_subtrees(spark):
    items = spark.createDataFrame([(4,), (4,), (5,), (3,), (99,)], "category_id long")
    got = {r.id: r.product_num for r in
           rollup_counts(tree_paths(_adjacency(spark)), items, "category_id").collect()}
    assert got == {1: 4, 2: 3, 3: 1, 4: 2, 5: 1}


def test_work_list_skips_explicit_zero_and_keeps_unknown(spark):
    leaves = leaf_paths(_adjacency(spark), name_en_cn_id())
    counts = spark.createDataFrame([(4, 0), (5, 7)], "id long, product_num long")
    got = {r.id: (r.product_num, r.cat_idx, r.total_cats) for r in
           work_list(leaves, counts).collect()}
    assert got == {5: (7, 2, 3), 3: (None, 3, 3)}


def test_work_list_falls_back_to_catalog_leaves(spark):
    empty = leaf_paths(spark.createDataFrame([], S.CATEGORY_SCHEMA), name_en_cn_id())
    cat = breadcrumb_leaves(unroll_tree(_doc(spark, CATALOG), CATALOG_NODE), label_en_id)
    out = work_list(empty, None, catalog_leaves=cat.drop("product_num")).collect()
    assert [(r.id, r.path) for r in out] == [(10, "Tools")]


def test_api_envelopes_unwrapped(spark, scratch):
    import os

    from partsmith.sources.documents import read_json_files, unwrap, parse_facets

    os.makedirs(f"{scratch}/tree")
    with open(f"{scratch}/tree/r1.json", "w") as f:
        json.dump({"code": 200, "result": TREE}, f, indent=2)  # pretty-printed, one per file
    docs = read_json_files(spark, f"{scratch}/tree")
    nodes = unroll_tree(docs, root_path="$.result")
    assert sorted(r.id for r in nodes.collect()) == [10, 11, 12]
    cat = _doc(spark, {"result": {"catalogList": CATALOG}})
    leaves = breadcrumb_leaves(unroll_tree(cat, CATALOG_NODE, root_path="$.result.catalogList"),
                               label_en_id)
    assert [(r.id, r.product_num) for r in leaves.collect()] == [(10, 9)]
    facet = _doc(spark, {"result": {"totalCount": 3, "Manufacturer": [{"id": "9", "name": "X"}]}})
    assert [(r.brand_id, r.total_count) for r in parse_facets(unwrap(facet, "$.result")).collect()] == [(9, 3)]


def test_catalog_count_defaults_to_zero(spark):
    cats = [{"catalogId": 5, "catalogNameEn": "No count"}]
    leaves = breadcrumb_leaves(unroll_tree(_doc(spark, cats), CATALOG_NODE), label_en_id)
    assert [(r.id, r.product_num) for r in leaves.collect()] == [(5, 0)]


def test_roots_with_zero_parent_and_orphans_are_kept(spark):
    rows = [(1, 0, "Zero", None, None), (2, 1, "A", None, None), (3, 77, "Orphan", None, None),
            (4, 3, "Below", None, None)]
    nodes = spark.createDataFrame(rows, S.CATEGORY_SCHEMA)
    got = {r.id: (r.depth, r.preorder_pos) for r in flatten(nodes).collect()}
    assert got == {1: (0, 1), 2: (1, 2), 3: (0, 3), 4: (1, 4)}
    assert {r.id: r.path for r in leaf_paths(nodes).collect()} == {2: "Zero > A", 4: "Orphan > Below"}


def test_cycles_are_an_error_and_depth_is_not_limited(spark):
    import pytest

    bad = spark.createDataFrame([(1, None, "R", None, None), (2, 3, "x", None, None),
                                 (3, 2, "y", None, None)], S.CATEGORY_SCHEMA)
    with pytest.raises(ValueError, match="cycle"):
        tree_paths(bad)
    chain = spark.createDataFrame([(i, i - 1, f"n{i}", None, None) for i in range(1, 12)],
                                  S.CATEGORY_SCHEMA)
    assert tree_paths(chain).agg({"depth": "max"}).first()[0] == 10


def test_a_deep_chain_takes_few_rounds(spark, monkeypatch):
    from partsmith.operators import tree as M

    rounds = []
    real = M.materialize
    monkeypatch.setattr(M, "materialize", lambda df: rounds.append(1) or real(df))
    chain = spark.createDataFrame([(i, i - 1 or None, f"n{i}", None, None) for i in range(1, 1001)],
                                  S.CATEGORY_SCHEMA)
    paths = tree_paths(chain)
    last = paths.where("id = 1000").first()
    assert last.depth == 999 and last.path_ids == list(range(1, 1001))
    assert paths.agg({"depth": "sum"}).first()[0] == sum(range(1000))
    assert len(rounds) <= 12


def test_long_cycles_with_tails_are_an_error(spark):
    import pytest

    ring = [(i, i % 50 + 1) for i in range(1, 51)] + [(i, i - 1) for i in range(100, 120)] + [(99, 7)]
    nodes = spark.createDataFrame([(i, p, "x", None, None) for i, p in ring], S.CATEGORY_SCHEMA)
    with pytest.raises(ValueError, match="cycle"):
        tree_paths(nodes)


def test_path_keys_sort_in_preorder(spark):
    rows = [(10, None), (2, 10), (30, 10), (4, 2), (5, 30), (1, None), (7, 4)]
    nodes = spark.createDataFrame([(i, p, f"n{i}", None, None) for i, p in rows], S.CATEGORY_SCHEMA)
    got = [r.id for r in flatten(nodes).orderBy("preorder_pos").collect()]
    assert got == [1, 10, 2, 4, 7, 30, 5]
