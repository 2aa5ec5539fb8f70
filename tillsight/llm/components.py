"""Connected components of a table of links, by alternating stars and without collecting any."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.common import save


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b); root is the smallest node of its component.

    Large-star and small-star steps shrink the components to stars in about log n rounds. Each
    round is written to the shared folder. A node's smallest neighbour is an aggregate that
    Spark combines before the shuffle, and the joins on a node can be split by AQE, so a hub
    with very many links stays spread.
    """
    edges = save(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    state = None
    while (now := tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())) != state:
        state = now
        edges = save(small_star(large_star(edges)))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b")).distinct()


def large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()
