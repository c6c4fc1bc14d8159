"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Rounds after which something is wrong (each roughly halves the longest path).
MAX_ROUNDS = 100


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points to the node's smallest one."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = materialize(both.groupBy("a").agg(F.min("b").alias("least")).select(
        F.col("a").alias("node"), F.least("a", "least").alias("least")), "least")
    return both.join(low, both["a"] == low["node"]).filter("b > a and b <> least").select(
        F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours point to the smallest of them."""
    low = materialize(edges.groupBy("a").agg(F.min("b").alias("least")).withColumnRenamed(
        "a", "node"), "least")
    moved = edges.join(low, edges["a"] == low["node"]).filter("b <> least").select(
        F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(low.select(F.col("node").alias("a"), F.col("least").alias("b"))).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of an edge that leads to another node;
    component is the smallest node that edges reach. Each round, and the least
    neighbours it joins with, is written to the shared checkpoint folder (so that
    Spark can split a node with very many edges in the join); no edge comes to
    the driver."""
    now = materialize(edges.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "edges")
    state = None
    for _ in range(MAX_ROUNDS):
        now = materialize(_small_star(_large_star(now)), "edges")
        seen = now.agg(F.count("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == state:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        state = tuple(seen)
    raise RuntimeError("components did not settle")
