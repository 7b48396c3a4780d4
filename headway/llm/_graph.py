"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm._common import settled


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes with an edge (a, b); component: the smallest node that can be reached.

    Alternates two steps until nothing changes: every larger neighbour of a node is tied to the
    smallest neighbour (large star), then every smaller neighbour and the node itself (small star).
    The number of edges never grows, and the number of rounds is about the logarithm of the
    longest path. Minima are formed before rows are dealt, so a node with many edges is one row a task.
    """
    edges = settled(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("of"), F.least("a", "m").alias("m"))
        large = both.join(least, F.col("a") == F.col("of")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small_least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "of")
        tied = large.join(small_least, F.col("a") == F.col("of"))
        small = tied.select(F.col("b").alias("a"), F.col("m").alias("b")).union(tied.select("a", F.col("m").alias("b")))
        edges = settled(small.where("a <> b").distinct())
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
    return edges.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node").union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
