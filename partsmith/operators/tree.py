"""Category trees: flatten, leaves with breadcrumbs, per-node rollups, work lists.

Trees are stored as an adjacency list (``id``, ``parent_id``).  Everything is
derived from one top-down walk that gives each node its root path (ids and
names): pre-order is the order of the path keys, a breadcrumb is the joined
names, and exploding the path ids gives the ancestor closure.  The paths come from
pointer jumping: every node knows a part of its path and the ancestor above it, and each
round appends that ancestor's own part, so parts double and a tree of depth d takes about
log2(d) joins.  Rounds are checkpointed to cut the lineage; nodes that have reached their
root drop out of the join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partsmith.operators.ordering import global_index, materialize

BREADCRUMB_SEP = " > "  # fixed value: breadcrumb separator
KEY_WIDTH = 20          # digits of a zero-padded id inside a pre-order key


def name_en_cn_id(id_col: str = "id") -> Column:
    """Node label: English name, else local name, else the id."""
    return F.coalesce(F.nullif(F.col("name_en"), F.lit("")),
                      F.nullif(F.col("name_cn"), F.lit("")),
                      F.col(id_col).cast("string"))


def name_en_id(id_col: str = "id", name_col: str = "name_en") -> Column:
    """Node label: English name, else the id."""
    return F.coalesce(F.nullif(F.col(name_col), F.lit("")), F.col(id_col).cast("string"))


def _key(id_col: Column) -> Column:
    return F.lpad(id_col.cast("string"), KEY_WIDTH, "0")


def tree_paths(nodes: DataFrame, label: Column | None = None, id_col: str = "id",
               parent_col: str = "parent_id") -> DataFrame:
    """Every node with its root path: a root is a node whose parent is NULL, 0 or not in the
    table (an orphan).  A table with a cycle is an error.  Columns: ``depth``
    (root = 0), ``path_ids`` (root ... node), ``path_names`` (labels along the
    path) and ``path_key`` (pre-order sort key; siblings ordered by id)."""
    label = label if label is not None else name_en_id(id_col)
    named = nodes.select(F.col(id_col).alias("__id"), F.col(parent_col).alias("__parent"),
                         label.alias("__label"))
    ids = named.select(F.col("__id").alias("__known")).distinct()
    # part of the path below ``up``, the next ancestor (null: the part begins at the root)
    todo = materialize(named.join(ids, F.col("__parent") == F.col("__known"), "left").select(
        "__id", F.when(F.col("__parent") != 0, F.col("__known")).alias("up"),
        F.array("__id").alias("path_ids"), F.array("__label").alias("path_names"),
        _key(F.col("__id")).alias("path_key")))
    done = []
    while True:
        done.append(todo.where("up is null"))
        open_ = todo.where("up is not null")
        n_open, on_cycle = open_.agg(F.count(F.lit(1)),
                                     F.count_if(F.array_contains("path_ids", F.col("up")))).first()
        # every node has one parent, so a part that meets its own beginning hangs on a cycle
        if on_cycle:
            raise ValueError("the category table has a cycle")
        if not n_open:
            break
        held = reduce(lambda a, b: a.unionByName(b), done).unionByName(open_).select(
            F.col("__id").alias("__at"), F.col("up").alias("__up"),
            F.col("path_ids").alias("__ids"), F.col("path_names").alias("__names"),
            F.col("path_key").alias("__key"))
        todo = materialize(open_.join(held, F.col("up") == F.col("__at")).select(
            "__id", F.col("__up").alias("up"), F.concat("__ids", "path_ids").alias("path_ids"),
            F.concat("__names", "path_names").alias("path_names"),
            F.concat("__key", F.lit("/"), "path_key").alias("path_key")))
    walked = reduce(lambda a, b: a.unionByName(b), done)
    return walked.select(F.col("__id").alias(id_col), (F.size("path_ids") - 1).alias("depth"),
                         "path_ids", "path_names", "path_key")


def flatten(nodes: DataFrame, id_col: str = "id", parent_col: str = "parent_id") -> DataFrame:
    """All nodes in pre-order: the node's own columns plus ``depth``,
    ``path_key`` and the 1-based ``preorder_pos``."""
    paths = tree_paths(nodes, id_col=id_col, parent_col=parent_col).select(
        id_col, "depth", "path_key")
    flat = nodes.join(paths, id_col, "inner")
    return global_index(flat, ["path_key"], "preorder_pos")


def leaves(nodes: DataFrame, id_col: str = "id", parent_col: str = "parent_id") -> DataFrame:
    """Nodes that are nobody's parent."""
    parents = nodes.select(F.col(parent_col).alias(id_col)).filter(F.col(id_col).isNotNull())
    return nodes.join(parents.distinct(), id_col, "left_anti")


def leaf_paths(nodes: DataFrame, label: Column | None = None, id_col: str = "id",
               parent_col: str = "parent_id") -> DataFrame:
    """Leaves with their breadcrumb ``A > B > C`` (``path``) and pre-order key;
    leaves whose id is NULL or 0 are dropped."""
    paths = tree_paths(nodes, label, id_col, parent_col)
    lf = leaves(nodes, id_col, parent_col).select(id_col)
    out = paths.join(lf, id_col, "left_semi").filter(
        F.col(id_col).isNotNull() & (F.col(id_col) != 0))
    return out.select(id_col, F.array_join("path_names", BREADCRUMB_SEP).alias("path"),
                      "depth", "path_key", "path_ids")


def ancestor_closure(paths: DataFrame, id_col: str = "id") -> DataFrame:
    """``(id, ancestor)`` for every node and each node on its root path
    (itself included)."""
    return paths.select(id_col, F.explode("path_ids").alias("ancestor"))


def rollup_counts(paths: DataFrame, items: DataFrame, item_category: str,
                  id_col: str = "id") -> DataFrame:
    """Items per node, counting every item under the node's subtree.

    Items are first counted per category (partial aggregation: a category
    holding a third of the items is reduced map-side), then spread over the
    ancestor closure and summed per ancestor.  Nodes without items get 0."""
    per_cat = items.groupBy(F.col(item_category).alias(id_col)).agg(
        F.count(F.lit(1)).alias("__n"))
    closure = ancestor_closure(paths, id_col)
    spread = closure.join(per_cat, id_col, "inner").groupBy("ancestor").agg(
        F.sum("__n").alias("product_num"))
    return (paths.select(id_col, "depth")
            .join(spread.withColumnRenamed("ancestor", id_col), id_col, "left")
            .select(id_col, "depth", F.coalesce("product_num", F.lit(0)).cast("bigint")
                    .alias("product_num")))


def work_list(tree_leaves: DataFrame, catalog_counts: DataFrame | None,
              catalog_leaves: DataFrame | None = None, id_col: str = "id") -> DataFrame:
    """Leaf work list: every leaf with its known count (NULL when unknown),
    a 1-based ``cat_idx`` in pre-order and ``total_cats``; leaves whose count
    is *explicitly* 0 are skipped (their index stays reserved).  When the tree
    has no leaves the catalog's own leaves are used instead."""
    base = tree_leaves
    if catalog_leaves is not None and tree_leaves.isEmpty():
        base = catalog_leaves
    if catalog_counts is not None:
        base = base.join(catalog_counts.select(id_col, "product_num"), id_col, "left")
    else:
        base = base.withColumn("product_num", F.lit(None).cast("bigint"))
    indexed = global_index(base, ["path_key"], "cat_idx")
    out = indexed.select("*", base.agg(F.count(F.lit(1))).scalar().alias("total_cats"))
    return out.filter(F.col("product_num").isNull() | (F.col("product_num") != 0))


def single_category_work_list(spark, category_id: int) -> DataFrame:
    """Work list of a run aimed at one category: that category alone, its
    count unknown (NULL), index 1 of 1.  Such a run expects no total and must
    not mark unseen products afterwards (the rest of the catalog was not
    visited)."""
    return spark.createDataFrame(
        [(int(category_id), f"Category #{int(category_id)}", None, 1, 1)],
        "id long, path string, product_num long, cat_idx long, total_cats long")
