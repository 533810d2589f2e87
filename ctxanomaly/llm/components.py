"""Connected components of an edge table, by alternating stars.

Large star hooks a node's larger neighbours to its smallest neighbour, small
star hooks its smaller ones; both alternate until the edges stay the same
(Kiveris et al., "Connected Components in MapReduce and Beyond").  Every
round is a pair of map-side combinable minima and joins on the node, written
to the shared folder, so a lost executor costs one round at most.  Only a
count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ctxanomaly.llm.common import cut


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    up = both.filter("b > a").join(low, "a")
    return up.select(F.col("m").alias("a"), "b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("b").agg(F.min("a").alias("m"))
    hooked = edges.join(low, "b").select(F.col("m").alias("lo"), F.explode(F.array("a", "b")).alias("hi"))
    return hooked.filter("lo < hi").select(F.col("lo").alias("a"), F.col("hi").alias("b")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (a, b with a < b, longs)
    that is not itself the smallest of its component."""
    edges = cut(edges, "edges")
    before = _checksum(edges)
    while True:
        edges = cut(_small_star(_large_star(edges)), "edges")
        after = _checksum(edges)
        if after == before:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
        before = after
