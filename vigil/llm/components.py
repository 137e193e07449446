"""Connected components of an edge table by alternating large-star and small-star steps.

Each step joins every node with the smallest of its neighbourhood; the edges of a component end
as a star around its smallest node after logarithmically many steps. A hub is aggregated
partially before its shuffle, and the joins on it may be split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from vigil.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """``edges``: (a, b) of any one orderable type. Returns (node, label) for every node that is
    not the smallest of its component, ``label`` being that smallest node. Loops, repeated edges
    and nulls are dropped."""
    star, state = _written(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        before = state
        star, state = _written(_small_star(_large_star(star)))
        if state == before:
            return star.select(F.col("a").alias("node"), F.col("b").alias("label"))


def _written(e: DataFrame) -> tuple[DataFrame, dict]:
    """The edges as a table, and their number and checksum, taken while they are written."""
    seen = Observation()
    out = materialize(e.observe(seen, F.count(F.lit(1)).alias("n"),
                                F.bit_xor(F.xxhash64("a", "b")).alias("sum")), "edges")
    return out, seen.get


def _large_star(e: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("m"))
    return (both.join(low, both["a"] == low["node"]).filter("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them (all of e has b < a)."""
    low = e.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "node")
    moved = (e.join(low, e["a"] == low["node"]).filter("b <> m")
             .select(F.col("b").alias("a"), F.col("m").alias("b")))
    return moved.union(low.select(F.col("node").alias("a"), F.col("m").alias("b"))).distinct()
