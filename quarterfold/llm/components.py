"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterfold.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Points neighbours to a node's smallest one. Joins rather than windows, so that hot nodes can be split."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    to = both.join(least, "u")
    if large:
        return to.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    moved = to.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable, for every node with an edge. edges: a, b; either way round."""
    e = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        e = written(_star(_star(e, True), False), "stars")
        state = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct()
