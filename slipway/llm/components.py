"""Connected components of a graph of any size, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slipway.llm.frames import dropped, stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _signature(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _least_near(near: DataFrame) -> DataFrame:
    """For each ``a``, ``least``: the least of it and all that it is paired with.

    It is written before anything joins it: adaptive execution splits a large partition of a join only where nothing
    is aggregated between the shuffle and the join.
    """
    least = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return stored(least, "least")


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` for every long that ``edges`` (``a``, ``b``) names; the label is its component's least node.

    Each round hangs every node's greater neighbours, then its lesser ones, on the least node next to it; rounds needed
    grow with the logarithm of the longest chain, not with its length. Nodes with very many edges only matter for
    minima, which are combined before the shuffle and written, and for joins with these minima, whose large partitions
    adaptive execution splits.
    No edges: no rows. Loops and repeated edges change nothing. Null ends are left out.
    """
    edges = edges.where(F.col("a") != F.col("b"))
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stored(edges, "edges")
    before = _signature(edges)
    while before[0]:
        near = _both_ways(edges)
        first = _least_near(near)
        large = near.join(first, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        near = stored(large.where("a > b").distinct(), "edges")
        second = _least_near(near)
        small = near.join(second, "a").select("a", "b", "least")
        small = small.select(F.col("b").alias("a"), F.col("least").alias("b")).union(
            small.select("a", F.col("least").alias("b"))
        )
        following = stored(small.where("a <> b").distinct(), "edges")
        dropped(first, near, second)
        after = _signature(following)
        dropped(edges)
        edges = following
        if after == before:
            break
        before = after
    return (
        edges.groupBy(F.col("a").alias("node"))
        .agg(F.min("b").alias("label"))
        .union(edges.select("b", "b").distinct())
    )
