"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisa.session import write_out


def _lowest(edges: DataFrame) -> DataFrame:
    """Each left end with its lowest right end; combined before the shuffle, so hubs cost one row a task."""
    return edges.groupBy("a").agg(F.min("b").alias("low"))


def _stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one node, which hangs on none."""
    ends = edges.select(F.posexplode(F.array("a", "b")).alias("low", "node"))
    ends = ends.groupBy("node").agg(F.sum(1 - F.col("low")).alias("ups"), F.max("low").alias("low"))
    return ends.where("ups > 1 or (ups = 1 and low = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; a component is named by its lowest node.

    A round joins edges to the lowest neighbour of each node; no neighbour list is ever gathered. The
    number of rounds grows with the logarithm of a component's size. Each round is written out, so a
    lost executor never costs earlier rounds. Empty edges give no rows; loops and repeats don't matter.
    """
    now = write_out(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _stars(now):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Large star: neighbours above a node hang on the lowest of the node and its neighbours.
        large = both.join(_lowest(both), "a").where("b > a").select(F.col("b").alias("a"), F.least("a", "low").alias("b")).distinct()
        # Small star: a node and its lower neighbours hang on the lowest of them.
        joined = large.join(_lowest(large), "a")
        small = joined.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).union(joined.select("a", F.col("low").alias("b")))
        now = write_out(small.distinct(), "edges")
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots.select("node", F.col("node").alias("component")))
