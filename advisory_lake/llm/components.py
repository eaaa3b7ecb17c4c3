"""Connected components of an edge table, on Spark.

Every partition first unites its edges with union-find, which leaves one edge per node.
Alternating large-star and small-star steps then pull all nodes of a component to its
smallest node. Each step is a grouped minimum and a join; its rows are written to the shared
folder, so lineage stays short. Nothing but a count and a checksum reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from advisory_lake.llm.shared import written

BLOCK = 1_000_000  # edges that a task unites at once


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) edges between longs to (node, component), the smallest node of each component.

    Nodes without an edge do not appear. Repeated edges, either direction and edges from a node
    to itself are fine; nulls are left out.
    """
    stars = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
    stars = written(stars.mapInPandas(_united, "a LONG, b LONG").distinct(), "stars")
    seen = None
    while (now := _checksum(stars)) != seen:
        seen = now
        stars = written(_small_star(_large_star(stars)), "stars")
    nodes = stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _united(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edges of a task to stars (node, smallest node), a block of edges at a time."""
    parent: dict[int, int] = {}
    taken = 0

    def root(node: int) -> int:
        top = parent.setdefault(node, node)
        while parent[top] != top:
            top = parent[top]
        while parent[node] != top:
            parent[node], node = top, parent[node]
        return top

    def stars() -> pd.DataFrame:
        pairs = [(node, root(node)) for node in parent if root(node) != node]
        return pd.DataFrame(pairs, columns=["a", "b"], dtype="int64")

    for frame in frames:
        for a, b in zip(frame["a"].tolist(), frame["b"].tolist()):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
        taken += len(frame)
        if taken >= BLOCK:
            yield stars()
            parent.clear()
            taken = 0
    yield stars()


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node move to its smallest neighbour, or to itself if it is smaller."""
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them; edges run downwards."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", F.col("least").alias("b"))).distinct()
