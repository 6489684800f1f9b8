"""Connected components by alternating large and small stars, each round written to the checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import checkpointed


def _least(edges: DataFrame) -> DataFrame:
    """``(a, least)``: the least of each node and its neighbours ``b``; folded before the shuffle."""
    return edges.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("least", "a"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    larger = both.filter("b > a").join(_least(both), "a")
    return larger.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the least of them. Edges run from large to small."""
    joined = edges.join(_least(edges), "a")
    moved = joined.filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(joined.select("a", F.col("least").alias("b"))).distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def component_labels(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``: the least node it reaches. Loops and repeats do no harm.

    Each star halves paths at least; the rounds end when the edges stay the same, and then they are the stars themselves.
    """
    ordered = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = checkpointed(ordered.distinct())
    known = _digest(current)
    while known[0]:
        current = checkpointed(_small_star(_large_star(current)))
        found = _digest(current)
        if found == known:
            break
        known = found
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
