"""Connected components by alternating large and small stars.

Either star is one shuffle: a node's edges meet in one window, whose smallest neighbour the others
are tied to; a window of very many edges is spilled by Spark, not held. Rounds end when the edges
stay as they are, which their number and the sums of their hashes tell.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._spark import checkpoint


def _neighbours(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) once, with the smallest neighbour of u."""
    return (edges.repartition("u").distinct()
            .withColumn("first", F.min("v").over(Window.partitionBy("u"))))


def _large(edges: DataFrame) -> DataFrame:
    """Larger neighbours are tied to the smallest of a node and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _neighbours(both).filter("v > u").select(F.col("v").alias("u"), F.least("u", "first").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    own = F.when(F.col("v") == F.col("first"), F.col("u")).otherwise(F.col("v"))
    return _neighbours(edges).select(own.alias("u"), F.col("first").alias("v"))


def _stamp(edges: DataFrame) -> tuple:
    """How many edges there are, and what their hashes add up to."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.pmod(h, F.lit(1 << 30))), F.bit_xor(h)).first())


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node with an edge; a component's id is its smallest node."""
    u, v = F.greatest(F.col(a), F.col(b)), F.least(F.col(a), F.col(b))
    stars, before = checkpoint(edges.filter(F.col(a) != F.col(b)).select(u.alias("u"), v.alias("v"))), None
    for _ in range(max_rounds):
        now = _stamp(stars)
        if now == before:
            roots = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
        stars, before = checkpoint(_small(_large(stars))), now
    raise RuntimeError(f"components did not settle within {max_rounds} rounds")
