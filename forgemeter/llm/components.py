"""Connected components of an edge table, in Spark, by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgemeter.llm import tables


def _summary(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
    return row[0], row[1] or 0


def _hooked(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Each edge (u, v) with the least node next to v (itself included) in place of v's star.

    Large star: u > v ends of all edges hook to the least neighbour. Small star: only smaller
    neighbours count, and the node hooks to it too. Aggregates by node combine on the map side, and
    the join splits a hub's edges like any skewed key."""
    if both_ways:
        edges = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    if both_ways:
        least = least.select("u", F.least("u", "least").alias("least"))
        found = edges.filter("v > u").join(least, "u")
        return found.select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
    found = edges.join(least, "u")
    hooked = found.filter("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return hooked.unionAll(least.select("u", F.col("least").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (a, b): the smallest node reachable.

    Each round is written to the shared folder; rounds grow with the logarithm of the longest path.
    """
    larger, smaller = F.greatest("a", "b"), F.least("a", "b")
    current = edges.filter("a <> b").select(larger.alias("u"), smaller.alias("v")).distinct()
    current = tables.stage(current, "components")
    before = _summary(current)
    while before[0]:
        large = tables.stage(_hooked(current, True), "components")
        current = tables.stage(_hooked(large, False), "components")
        after = _summary(current)
        if after == before:
            break
        before = after
    roots = current.select(F.col("v").alias("node")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        roots.select("node", F.col("node").alias("component"))
    )


def local_roots(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For a small graph as a symmetric matrix: the least id that each node reaches."""
    least = ids.copy()
    while True:
        around = np.where(linked, least[None, :], np.iinfo(np.int64).max).min(axis=1)
        nearer = np.minimum(least, around)
        if (nearer == least).all():
            return least
        least = nearer
