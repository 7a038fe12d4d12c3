"""Connected components of links between documents, without gathering links or components anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Alternations of star operations after which a run is taken to be broken; each halves distances at least.
MOST_ROUNDS = 64


def _is_settled(edges: DataFrame) -> bool:
    """Whether every edge (a, b) leads from a node that has no other one to a node that none leads from."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("leaves"), F.lit(0).alias("enters"))
    ends = ends.union(edges.select("b", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("leaves").alias("leaves"), F.max("enters").alias("enters"))
    return nodes.filter("leaves > 1 or leaves = 1 and enters = 1").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    """For edges with a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its smallest node.

    Large-star and small-star operations alternate until all edges lead from a node to the smallest of its
    component. A node with very many links is only ever aggregated and joined.
    """
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = materialize(edges, "links")
    for _ in range(MOST_ROUNDS):
        if _is_settled(edges):
            break
        edges = materialize(_small_star(_large_star(edges).distinct()), "links")
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
