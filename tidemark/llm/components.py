"""Connected components of a graph given as edges: alternating large-star and small-star steps on tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges ``(a, b)``; a component is named by its smallest node.

    A large-star step hangs the larger neighbours of a node on its smallest one, a small-star step the smaller ones;
    both only regroup edges, so a node with very many neighbours costs partial minima and a join that can be split.
    Every step is written to the shared folder.  Few steps are needed: paths shrink to stars in logarithmic time."""
    edges = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = edges.select(F.col("b").alias("a"), F.col("a").alias("v")).join(least, "a").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = stored(large.filter("a <> b").distinct(), "large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        edges = stored(small.filter("a <> b").distinct(), "small")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == now:
            break
        mark = now
    roots = edges.select(F.col("b").alias("node")).distinct()
    return stored(edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))), "components")
