"""Category tree queries over region -> nation -> customer, with orders as the
catalog's products (an order's category is its customer leaf)."""

from __future__ import annotations

from pyspark.sql import functions as F

from partsmith.operators.tree import (
    flatten,
    leaf_paths,
    name_en_cn_id,
    name_en_id,
    rollup_counts,
    tree_paths,
    work_list,
)
from partsmith.plans.bindings import CATEGORIES_SQL, categories_from_tables, t
from partsmith.plans.registry import query
from partsmith.session import scratch_path
from partsmith.sources.documents import parse_facets, read_json_lines, unwrap
from partsmith.sources.trees import (
    CATALOG_NODE,
    CATEGORY_NODE,
    breadcrumb_leaves,
    category_records,
    label_en_id,
    unroll_tree,
)

LEAF_OFFSET = 1000  # leaf category id = 1000 + c_custkey (see bindings)


def _nodes(spark, sf):
    return categories_from_tables(t(spark, sf, "region"), t(spark, sf, "nation"),
                                  t(spark, sf, "customer"))


def _items(spark, sf):
    """Orders as catalog items, categorised by their customer's leaf."""
    return t(spark, sf, "orders").select(
        (F.col("o_custkey") + LEAF_OFFSET).alias("category_id"), "o_orderstatus")


def _walk_sql(label_sql: str) -> str:
    return f"""nodes AS ({CATEGORIES_SQL}),
walk(id, depth, path, path_key) AS (
  SELECT id, 0, {label_sql}, lpad(CAST(id AS VARCHAR), 20, '0') FROM nodes WHERE parent_id IS NULL
  UNION ALL
  SELECT n.id, w.depth + 1, w.path || ' > ' || {label_sql.replace('name_', 'n.name_').replace('CAST(id', 'CAST(n.id')},
         w.path_key || '/' || lpad(CAST(n.id AS VARCHAR), 20, '0')
  FROM nodes n JOIN walk w ON n.parent_id = w.id),
leaf AS (SELECT * FROM walk WHERE id NOT IN (SELECT parent_id FROM nodes WHERE parent_id IS NOT NULL)
         AND id <> 0)"""


EN_CN_ID = "coalesce(nullif(name_en, ''), nullif(name_cn, ''), CAST(id AS VARCHAR))"
EN_ID = "coalesce(nullif(name_en, ''), CAST(id AS VARCHAR))"


# --- N2 + P12 + T4: every node, pre-order -------------------------------------
@query("category_flatten", sql=f"""
WITH RECURSIVE {_walk_sql(EN_ID)}
SELECT n.id, n.parent_id, n.name_en, n.name_cn, n.code, w.depth, w.path_key,
       row_number() OVER (ORDER BY w.path_key) AS preorder_pos
FROM nodes n JOIN walk w ON n.id = w.id""")
def category_flatten(spark, sf):
    """Every node of the region -> nation -> customer tree in pre-order."""
    return flatten(_nodes(spark, sf)).select(
        "id", "parent_id", "name_en", "name_cn", "code", "depth", "path_key", "preorder_pos").orderBy(
        "preorder_pos")


# --- N3: leaves with breadcrumb (en -> cn -> id) --------------------------------
@query("category_leaf_paths", sql=f"""
WITH RECURSIVE {_walk_sql(EN_CN_ID)}
SELECT id, path FROM leaf""")
def category_leaf_paths(spark, sf):
    """Leaves with breadcrumbs (English, else local name, else id)."""
    return leaf_paths(_nodes(spark, sf), name_en_cn_id()).select("id", "path")


# --- N4 + A4: catalog leaves with counts; expected total over all leaves ----------
@query("category_leaf_counts", sql=f"""
WITH RECURSIVE {_walk_sql(EN_ID)},
cnt AS (SELECT o_custkey + 1000 AS id, count(*) AS n FROM orders GROUP BY 1),
lc AS (SELECT leaf.id, leaf.path, coalesce(cnt.n, 0) AS product_num FROM leaf LEFT JOIN cnt ON leaf.id = cnt.id)
SELECT id, path, product_num, (SELECT CAST(sum(product_num) AS BIGINT) FROM lc) AS total_expected FROM lc""")
def category_leaf_counts(spark, sf):
    """Leaves with their order counts and the expected total."""
    leaves = leaf_paths(_nodes(spark, sf), name_en_id())
    per_leaf = _items(spark, sf).groupBy(F.col("category_id").alias("id")).agg(
        F.count(F.lit(1)).alias("n"))
    lc = leaves.join(per_leaf, "id", "left").select(
        "id", "path", F.coalesce("n", F.lit(0)).cast("bigint").alias("product_num"))
    total = lc.agg(F.sum("product_num").cast("bigint")).scalar()
    return lc.select("id", "path", "product_num", total.alias("total_expected"))


# --- A7: per-node counts, every node counts its whole subtree ----------------------
@query("category_count_rollup", sql=f"""
WITH RECURSIVE nodes AS ({CATEGORIES_SQL}),
walk(id, depth, anc) AS (
  SELECT id, 0, [id] FROM nodes WHERE parent_id IS NULL
  UNION ALL
  SELECT n.id, w.depth + 1, list_append(w.anc, n.id) FROM nodes n JOIN walk w ON n.parent_id = w.id),
cnt AS (SELECT o_custkey + 1000 AS id, count(*) AS n FROM orders GROUP BY 1),
spread AS (SELECT a.ancestor AS id, sum(cnt.n) AS n
           FROM (SELECT id, unnest(anc) AS ancestor FROM walk) a JOIN cnt ON a.id = cnt.id GROUP BY 1)
SELECT w.id, w.depth, CAST(coalesce(s.n, 0) AS BIGINT) AS product_num
FROM walk w LEFT JOIN spread s ON w.id = s.id""")
def category_count_rollup(spark, sf):
    """Order counts per node, each node counting its whole subtree."""
    paths = tree_paths(_nodes(spark, sf))
    return rollup_counts(paths, _items(spark, sf), "category_id").select(
        "id", "depth", "product_num")


# --- J2 + F8 + W3: leaf work list, explicit zero counts skipped --------------------
@query("category_work_list", sql=f"""
WITH RECURSIVE {_walk_sql(EN_CN_ID)},
cnt AS (SELECT o_custkey + 1000 AS id, count(*) FILTER (WHERE o_orderstatus = 'F') AS n
        FROM orders GROUP BY 1),
w AS (SELECT leaf.id, leaf.path, cnt.n AS product_num,
             row_number() OVER (ORDER BY leaf.path_key) AS cat_idx,
             count(*) OVER () AS total_cats
      FROM leaf LEFT JOIN cnt ON leaf.id = cnt.id)
SELECT id, path, product_num, cat_idx, total_cats FROM w
WHERE product_num IS NULL OR product_num <> 0""")
def category_work_list(spark, sf):
    """Leaf work list: known counts, explicit zeros skipped, 1-based index."""
    tree_leaves = leaf_paths(_nodes(spark, sf), name_en_cn_id())
    counts = _items(spark, sf).groupBy(F.col("category_id").alias("id")).agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("product_num"))
    return work_list(tree_leaves, counts).select(
        "id", "path", "product_num", "cat_idx", "total_cats")


# --- S2-S4: landed API responses, scanned back -----------------------------------------------
BUCKET = 5000  # customers (by key) that one response holds at most


def _tree_documents(spark, sf, layout: dict[str, str]) -> str:
    """region -> nation -> customers as nested API responses, one JSON line for each nation and
    range of customer keys, so their number grows with ``customer``; returns their folder.
    Regions name parent 0; regions without nations and nations without customers are leaves."""
    def node(row_id, parent, name, num, children):
        values = {"id": row_id, "parent_id": parent, "name_en": name,
                  "name_cn": F.lower(name), "code": F.concat(F.lit("N"), row_id.cast("string")),
                  "product_num": num, "children": children}
        return F.to_json(F.struct(*[values[k].alias(key) for k, key in layout.items()]))

    def inside(parts):
        return F.transform(F.array_sort(parts), lambda x: F.parse_json(x["j"]))

    c = t(spark, sf, "customer")
    leaf = node(F.col("c_custkey") + 1000, F.col("c_nationkey") + 100, F.col("c_name"),
                F.col("c_custkey") % 7, F.array().cast("array<variant>"))
    kids = c.groupBy("c_nationkey", F.floor(F.col("c_custkey") / BUCKET).alias("bucket")).agg(
        inside(F.collect_list(F.struct("c_custkey", leaf.alias("j")))).alias("kids"))
    n = t(spark, sf, "nation").join(kids, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    mid = node(F.col("n_nationkey") + 100, F.col("n_regionkey") + 1, F.col("n_name"),
               F.col("n_nationkey") * 3, F.coalesce("kids", F.array().cast("array<variant>")))
    n = n.select("n_regionkey", "n_nationkey", mid.alias("mid"))
    r = t(spark, sf, "region").join(n, F.col("r_regionkey") == F.col("n_regionkey"), "left")
    root = node(F.col("r_regionkey") + 1, F.lit(0), F.col("r_name"), F.lit(None).cast("bigint"),
                F.when(F.col("mid").isNotNull(), F.array(F.parse_json("mid"))))
    path = scratch_path(spark, "tree")
    r.select(F.concat(F.lit('{"code":200,"result":['), root, F.lit("]}")).alias("value")
             ).write.text(path)
    return path


_DOCS_SQL = f"""docs AS (
  SELECT r_regionkey, r_name, n_nationkey, n_name, bucket FROM region
  LEFT JOIN nation ON n_regionkey = r_regionkey
  LEFT JOIN (SELECT DISTINCT c_nationkey, c_custkey // {BUCKET} AS bucket FROM customer)
    ON c_nationkey = n_nationkey)"""


@query("tree_scan", sql=f"""
WITH {_DOCS_SQL}
SELECT id, parent_id, name_en, lower(name_en) AS name_cn, 'N' || id AS code, count(*) AS n_responses
FROM (
  SELECT CAST(r_regionkey + 1 AS BIGINT) AS id, CAST(0 AS BIGINT) AS parent_id, r_name AS name_en FROM docs
  UNION ALL
  SELECT n_nationkey + 100, r_regionkey + 1, n_name FROM docs WHERE n_nationkey IS NOT NULL
  UNION ALL
  SELECT c_custkey + 1000, c_nationkey + 100, c_name FROM customer
  WHERE c_nationkey IN (SELECT n_nationkey FROM docs))
GROUP BY ALL""")
def tree_scan(spark, sf):
    """Nodes of nested category responses as category rows, and how many responses hold each."""
    docs = read_json_lines(spark, _tree_documents(spark, sf, CATEGORY_NODE))
    rows = category_records(unroll_tree(docs, root_path="$.result"))
    return rows.groupBy("id", "parent_id", "name_en", "name_cn", "code").agg(
        F.count(F.lit(1)).alias("n_responses"))


@query("catalog_scan", sql=f"""
WITH {_DOCS_SQL},
leaf AS (
  SELECT c_custkey + 1000 AS id, r_name || ' > ' || n_name || ' > ' || c_name AS path,
         CAST(c_custkey % 7 AS BIGINT) AS product_num
  FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
  UNION ALL SELECT n_nationkey + 100, r_name || ' > ' || n_name, n_nationkey * 3 FROM docs
            WHERE n_nationkey IS NOT NULL AND bucket IS NULL
  UNION ALL SELECT r_regionkey + 1, r_name, 0 FROM docs WHERE n_nationkey IS NULL)
SELECT CAST(id AS BIGINT) AS id, path, CAST(product_num AS BIGINT) AS product_num,
       (SELECT CAST(sum(product_num) AS BIGINT) FROM leaf) AS total_expected FROM leaf""")
def catalog_scan(spark, sf):
    """Leaves of nested catalog responses with breadcrumb and count, and the total expected
    over all of them."""
    docs = read_json_lines(spark, _tree_documents(spark, sf, CATALOG_NODE))
    leaves = breadcrumb_leaves(unroll_tree(docs, CATALOG_NODE, root_path="$.result"),
                               label_en_id)
    total = leaves.agg(F.sum("product_num").cast("bigint")).scalar()
    return leaves.select("id", "path", "product_num", total.alias("total_expected"))


@query("facet_scan", sql="""
SELECT p_type, CASE WHEN k % 5 = 0 THEN NULL ELSE CAST(k AS BIGINT) END AS brand_id, p_brand AS brand_name,
       k % 5 = 0 AS rejected, total_count
FROM (SELECT p_type, p_brand, CAST(substr(p_brand, 7) AS BIGINT) AS k,
             sum(count(*)) OVER (PARTITION BY p_type)::BIGINT AS total_count
      FROM part GROUP BY p_type, p_brand)""")
def facet_scan(spark, sf):
    """Brands of each part type landed as facet responses (ids as text, as numbers, or
    unreadable), scanned back."""
    brands = t(spark, sf, "part").groupBy("p_type", "p_brand").agg(F.count(F.lit(1)).alias("n"))
    k = F.substring("p_brand", 7, 9).cast("bigint")
    ident = (F.when(k % 5 == 0, F.concat(F.lit('"x'), k.cast("string"), F.lit('"')))
             .when(k % 2 == 0, k.cast("string"))
             .otherwise(F.concat(F.lit('"'), k.cast("string"), F.lit('"'))))
    one = F.concat(F.lit('{"id":'), ident, F.lit(',"name":"'), F.col("p_brand"), F.lit('"}'))
    docs = brands.groupBy("p_type").agg(F.concat(  # as many brands as the dimension has
        F.lit('{"result":{"totalCount":'), F.sum("n").cast("string"), F.lit(',"Manufacturer":['),
        F.array_join(F.collect_list(one), ","), F.lit("]}}")).alias("doc"))
    return parse_facets(unwrap(docs, "$.result")).select(
        "p_type", "brand_id", "brand_name", "rejected", "total_count")
