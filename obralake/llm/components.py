"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import store


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(`node`, `root`) for every node of `edges` (`a`, `b`); the root is the smallest node.

    Alternates two steps until nothing changes: each node hangs its larger neighbours on its smallest
    neighbour, then its smaller ones. Steps are aggregates and joins of stored tables, so that a hub
    is split like any skewed key.
    """
    edges = store(edges.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while (now := _state(edges)) != state:
        state = now
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = store(both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m")), "least")
        large = store(edges.select(F.col("b").alias("a"), F.col("a").alias("b")).join(least, "a").select(
            F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large")
        least = store(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        joined = large.join(least, "a")
        edges = store(least.select("a", F.col("m").alias("b")).union(
            joined.filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        ).distinct(), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
