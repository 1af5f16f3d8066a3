"""Connected components of an edge table, without collecting it.

Alternating large-star and small-star rounds (Kiveris et al., 2014): the number
of rounds grows with the logarithm of the longest path, every step is a
pre-aggregated minimum and a join, and each round is checkpointed in the shared
folder.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import reliable_checkpoint


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _least(sym: DataFrame) -> DataFrame:
    return sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node goes to the node's least neighbour."""
    sym = _both_ways(edges)
    return sym.join(_least(sym), "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the least of them (edges run from
    larger to smaller)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node in ``edges`` (u, v: bigint); the label is the
    component's smallest node.  Loops and repeated edges don't matter; nodes
    without edges aren't returned; an empty table gives an empty one."""
    e = edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = reliable_checkpoint(e)
    state = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            break
        state = now
        e = reliable_checkpoint(small_star(large_star(e)))
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
