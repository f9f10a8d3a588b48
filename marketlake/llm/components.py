"""Connected components of an edge table, by joins and grouped minima only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import stored


def both_ways(edges: DataFrame) -> DataFrame:
    turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return edges.select("a", "b").unionByName(turned)


def large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the node's smallest neighbour (or the node itself)."""
    near = both_ways(edges)
    least = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return near.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Each smaller neighbour of a node, and the node, are linked to its smallest neighbour."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root): the smallest node reachable, for every node that ``edges`` (a, b) mention.

    Alternates large and small stars until the edges are stars around their roots, in a number of rounds that grows
    with the logarithm of the longest path. Each round is written to the shared folder, so lost executors cost a round
    at most and plans stay short. A hub's edges are joined with its one minimum, so they can be split.
    """
    links = stored(edges.select("a", "b").where("a <> b").distinct(), name)
    mark = None
    while True:
        links = stored(small_star(large_star(links)), name)
        row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(row) == mark:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = tuple(row)
