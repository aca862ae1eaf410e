"""Nested category trees (API documents) -> adjacency lists.

Spark structs cannot recurse, so a node's children are parsed as an array of
JSON strings and unrolled level by level (one ``explode`` per tree level; the
loop runs as many times as the tree is deep).  Every node keeps the path of
sibling positions from its root, so the input's pre-order is recoverable with
a sort on ``path_key``.
"""

from __future__ import annotations

import itertools
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partsmith.functions.coerce import lax_long
from partsmith.operators.ordering import materialize

STR = T.StringType()
POS_WIDTH = 10

# fixed values: node layouts of the two tree documents
CATEGORY_NODE = {"id": "categoryId", "parent_id": "parentId", "name_en": "categoryNameEn",
                 "name_cn": "categoryNameCn", "code": "enCategoryCode", "children": "childrenList"}
CATALOG_NODE = {"id": "catalogId", "name_en": "catalogNameEn", "product_num": "productNum",
                "children": "childCatelogs"}
LONG_FIELDS = {"id", "parent_id", "product_num"}


def _node_schema(layout: dict[str, str]) -> T.StructType:
    fields = []
    for name, key in layout.items():
        dtype = T.ArrayType(STR) if name == "children" else STR
        fields.append(T.StructField(key, dtype, True))
    return T.StructType(fields)


def unroll_tree(roots_json: DataFrame, layout: dict[str, str] = CATEGORY_NODE,
                doc_col: str = "doc", root_path: str | None = None) -> DataFrame:
    """``roots_json``: one row per document holding a JSON *array* of root
    nodes (or, with ``root_path`` such as ``$.result``, a response whose
    array sits at that path).  Returns one row per node: the layout's scalar fields (ids as
    BIGINT), ``tree_parent_id`` (structural parent), ``depth``, ``is_leaf``
    (no children), ``path_key`` (sibling positions, pre-order sortable)."""
    schema = _node_schema(layout)
    doc = F.col(doc_col) if root_path is None else F.get_json_object(F.col(doc_col), root_path)
    docs = roots_json.select(doc.alias(doc_col), F.monotonically_increasing_id().alias("__doc"))
    roots = docs.select(
        "__doc", F.posexplode(F.from_json(F.col(doc_col), T.ArrayType(STR))).alias("__pos", "__node"))
    def label_struct(n: str):
        return F.struct(*[F.col(f"{n}.{layout[k]}").alias(k)
                          for k in ("id", "name_en", "name_cn") if k in layout])

    level = roots.select(
        F.from_json("__node", schema).alias("n"), F.lit(None).cast("bigint").alias("tree_parent_id"),
        F.lit(0).alias("depth"),
        F.concat(F.lpad(F.col("__doc").cast("string"), 20, "0"), F.lit("/"),
                 F.lpad(F.col("__pos").cast("string"), POS_WIDTH, "0")).alias("path_key"))
    level = level.withColumn("ancestors", F.array(label_struct("n")))
    level = materialize(level)
    levels = [level]
    ckey = layout["children"]
    for depth in itertools.count(1):
        nxt = level.select(
            lax_long(f"n.`{layout['id']}`").alias("tree_parent_id"),
            F.col("path_key").alias("__pkey"), F.col("ancestors").alias("__anc"),
            F.posexplode(F.col(f"n.{ckey}")).alias("__pos", "__node")).select(
            F.from_json("__node", schema).alias("n"), "tree_parent_id", F.lit(depth).alias("depth"),
            F.concat("__pkey", F.lit("/"), F.lpad(F.col("__pos").cast("string"), POS_WIDTH, "0"))
            .alias("path_key"), "__anc")
        nxt = nxt.withColumn("ancestors", F.concat("__anc", F.array(label_struct("n")))).drop("__anc")
        nxt = materialize(nxt)
        if nxt.isEmpty():
            break
        levels.append(nxt)
        level = nxt
    nodes = reduce(lambda a, b: a.unionByName(b), levels)
    cols = []
    for name, key in layout.items():
        if name == "children":
            continue
        v = F.col(f"n.{key}")
        if name == "product_num":  # a catalog node without a count has 0
            cols.append(F.coalesce(lax_long(f"n.`{key}`"), F.lit(0).cast("bigint")).alias(name))
            continue
        cols.append((lax_long(f"n.`{key}`") if name in LONG_FIELDS else v).alias(name))
    is_leaf = F.coalesce(F.size(F.col(f"n.{ckey}")) <= 0, F.lit(True))
    return nodes.select(*cols, "tree_parent_id", "depth", is_leaf.alias("is_leaf"), "path_key",
                        "ancestors")


def category_records(nodes: DataFrame) -> DataFrame:
    """Unrolled category nodes as ``categories`` rows (every node, pre-order);
    a missing English name becomes ""."""
    return nodes.select(F.col("id").cast("bigint").alias("id"),
                        F.col("parent_id").cast("bigint").alias("parent_id"),
                        F.coalesce(F.col("name_en"), F.lit("")).alias("name_en"),
                        "name_cn", "code", "path_key")


def label_en_cn_id(node) -> F.Column:
    """Category label: English name, else local name, else the id."""
    return F.coalesce(F.nullif(node["name_en"], F.lit("")), F.nullif(node["name_cn"], F.lit("")),
                      F.coalesce(node["id"], F.lit("None")))


def label_en_id(node) -> F.Column:
    """Catalog label: English name, else the id."""
    return F.coalesce(F.nullif(node["name_en"], F.lit("")), F.coalesce(node["id"], F.lit("None")))


def breadcrumb_leaves(nodes: DataFrame, label=label_en_cn_id, sep: str = " > ") -> DataFrame:
    """Leaves of an unrolled tree with the breadcrumb of labels along their
    root path; leaves whose id is NULL or 0 are dropped."""
    crumbs = F.array_join(F.transform("ancestors", label), sep)
    extra = [c for c in ["product_num"] if c in nodes.columns]
    return (nodes.filter(F.col("is_leaf") & F.col("id").isNotNull() & (F.col("id") != 0))
            .select("id", crumbs.alias("path"), "path_key", *extra))
