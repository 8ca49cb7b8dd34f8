"""Connected components of a graph given as a table of edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.shared import stage


def _least(edges: DataFrame) -> DataFrame:
    """Per node of edges (a, b) the least of it and its neighbours."""
    return stage(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "least")


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """node, root (least node of its component) for each end of edges (a, b).

    Each round hangs a node's larger neighbours on the least neighbour, then its smaller
    ones, until nothing changes; the rounds grow with the logarithm of the longest path.
    Loops and repeated edges do no harm; rounds are staged, so lineage stays short.
    """
    edges = stage(edges.where("a != b").select("a", "b").distinct(), "edges")
    mark = None
    while True:
        both = stage(_both(edges), "both")
        large = both.join(_least(both), "a").where("b > a and b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.distinct(), "large")
        # a hangs on its least smaller neighbour, and so do the other smaller ones
        small = large.join(_least(large), "a")
        hung = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            small.select("a", F.col("m").alias("b"))
        )
        edges = stage(hung.where("a != b").distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == now:
            break
        mark = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
