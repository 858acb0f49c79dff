"""Connected components by alternating stars; every step is a join, nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmill.session import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node moves to the smallest node around it."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
    moved = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them.  Edges go from larger to smaller."""
    low = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.where("a != b").unionByName(low.select("a", F.col("low").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b), the label being the smallest node of its component."""
    edges = materialise(
        links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    state = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            break
        state = now
        edges = materialise(_small_star(_large_star(edges)))
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("label"))).distinct()
