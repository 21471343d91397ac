"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.state import cut


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(neighbours: DataFrame, large: bool) -> DataFrame:
    """Link neighbours of u to the least of u's neighbourhood.

    A hub's neighbour list is never gathered: the minimum is a partial aggregate and comes
    back by a join that adaptive execution can split.
    """
    least = neighbours.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = neighbours.join(least, "u")
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("m").alias("u"), "v")
    else:
        out = joined.select(F.col("m").alias("u"), "v").unionByName(least.select(F.col("m").alias("u"), F.col("u").alias("v")))
    return out.where(F.col("u") != F.col("v")).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Return (node, component): every node that has an edge, and the least node it reaches.

    Self loops and rows with a null end say nothing and are dropped; an empty edge table
    gives an empty result. Rounds grow with the logarithm of the longest path; each round
    is checkpointed, so a lost executor costs one round at most.
    """
    e = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u != v")
    e = cut(e.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    before = _state(e)
    while before[0]:
        e = _star(_both_ways(e), large=True)
        # after the large star every edge runs from a smaller u to a larger v; the small star looks down from v
        e = cut(_star(e.select(F.col("v").alias("u"), F.col("u").alias("v")), large=False))
        after = _state(e)
        if after == before:
            break
        before = after
    leaves = e.select(F.col("v").alias("node"), F.col("u").alias("component"))
    roots = e.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    return leaves.unionByName(roots)
