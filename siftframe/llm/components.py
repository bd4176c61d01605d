"""Connected components of an edge table, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftframe.session import stage, unstage


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long): the smallest
    node reachable. Nodes without edges are not listed.

    Each round hangs every node's larger neighbours on its smallest one, then
    its smaller neighbours and itself on the smallest of those. A round's edges
    are written to the shared folder, so rounds neither grow a plan nor depend
    on the life of an executor. The number of rounds is logarithmic.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    now = stage(edges.where("a <> b").select(high.alias("u"), low.alias("v")).distinct(), "edges")
    seen = _mark(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        small = moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        before, now = now, stage(small, "edges")
        unstage(before.sparkSession, before)
        mark = _mark(now)
        if mark == seen:
            break
        seen = mark
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _mark(edges: DataFrame) -> tuple:
    hashed = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.sum(hashed.cast("decimal(38,0)")), F.bit_xor(hashed)).first())


class Forest:
    """Components inside one task, over numbers 0 to n - 1."""

    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        """True if they were apart."""
        i, j = self.find(i), self.find(j)
        self.parent[max(i, j)] = min(i, j)
        return i != j
