"""Connected components of a link table, as rounds of joins over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.sources.tables import durable


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step: link the neighbours of every node to the smallest id around it.

    The large step moves neighbours above the node, the small step the node and those below it.
    A node with very many neighbours is one row on the side of the minima, so Spark can split
    the other side of the join.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    lowest = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    moved = near.join(lowest, "a")
    if large:
        moved = moved.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        own = lowest.select("a", F.col("m").alias("b"))
        moved = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(own)
    return moved.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """`node`, `component` (smallest id reachable) for every node that has a link.

    `edges` has two long columns a and b; repeated links and links of a node to itself do no
    harm, null ends are left out. Rounds of large and small steps, each stored, end when a
    round changes nothing; their number grows with the logarithm of the longest path. Only a
    row count and a checksum come to the driver.
    """
    now = durable(edges.filter("a <> b").select("a", "b").distinct())
    mark = None
    while True:
        sums = now.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if sums[0] == 0 or tuple(sums) == mark:
            break
        mark = tuple(sums)
        now = durable(_stars(_stars(now, True), False))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


class Union:
    """Union-find over 0..n-1; roots are the smallest members."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)
