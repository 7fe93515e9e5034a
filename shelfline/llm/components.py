"""Connected components of a graph given as edges, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stage


def _nearest(sides: DataFrame) -> DataFrame:
    return sides.groupBy("a").agg(F.min("b").alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked with the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.join(_nearest(both), "a").where("b > a")
    return near.select(F.col("b").alias("a"), F.least("a", "least").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node's smaller neighbours, and the node, are linked with the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    near = down.join(_nearest(down), "a")
    moved = near.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
        near.select("a", F.col("least").alias("b"))
    )
    return moved.where("a <> b").distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row.n, row.h


def components(edges: DataFrame) -> DataFrame:
    """``a, b``: every node that is not the smallest of its component, with the smallest one.

    ``edges(a, b)`` join different longs; repeated ones do no harm. The minima combine inside
    each task and the joins have one unique side, so a node with very many edges is split by
    the adaptive join. Each round is written out, which keeps plans short and survives lost
    executors.
    """
    edges = stage(edges.select("a", "b").where("a <> b").distinct(), "edges")
    before = _state(edges)
    while before[0]:
        edges = stage(_small_star(stage(_large_star(edges), "large")), "small")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges
