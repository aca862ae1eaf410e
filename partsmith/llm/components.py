"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partsmith.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges ``(u, v)`` with u > v.  Large star: every larger neighbour of a node is
    linked to the node's smallest neighbour (or itself); small star: the node and its
    smaller neighbours are linked to the smallest of them."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both if large else edges
    low = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    j = near.join(low, "u")
    out = (j.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) if large
           else j.select(F.col("v").alias("u"), F.col("m").alias("v"))
           .unionByName(low.select("u", F.col("m").alias("v"))))
    return out.where("u != v").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node is either linked to one smaller node or only has larger ones."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).alias("up")),
        F.struct(F.col("v").alias("node"), F.lit(0).alias("up")))).alias("e")).select("e.*")
    n = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.count(F.lit(1)).alias("n"))
    return n.where("ups > 1 OR ups = 1 AND n > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node, comp`` (smallest node reachable) for every node of ``edges (u, v)``, both
    long.  Loops and repeated edges are harmless; an empty table gives an empty one."""
    cur = written(edges.where("u != v").select(F.greatest("u", "v").alias("u"),
                                               F.least("u", "v").alias("v")).distinct(), "edges")
    while not _are_stars(cur):
        cur = written(_star(_star(cur, True), False), "edges")
    return (cur.select(F.col("u").alias("node"), F.col("v").alias("comp"))
            .unionByName(cur.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()))
