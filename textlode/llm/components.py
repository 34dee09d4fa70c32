"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlode.sources.store import settle


def _all_stars(edges: DataFrame) -> bool:
    """Whether no root has a root of its own and no node two roots."""
    nodes = edges.groupBy("a").agg(F.count("*").alias("roots"))
    wrong = nodes.join(edges.select(F.col("b").alias("a"), F.lit(1).alias("root")), "a", "left")
    return wrong.filter("roots > 1 or root is not null").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """`(node, root)` for every node of `links(a, b)`; root is the smallest node reachable.

    Large-star and small-star steps alternate until only stars are left, which
    takes few rounds for groups of any shape.  Each round hands every node its
    smallest neighbour; the groupings combine before the shuffle and the joins
    are on plain keys, so a node with very many links is split by the skew join.
    """
    edges = settle(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _all_stars(edges):
        # Every neighbour above a node goes to the node's smallest neighbour, ...
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        # ... then every smaller neighbour of a node, and the node, to the smallest of them.
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = settle(small.unionByName(lowest.select("a", F.col("m").alias("b"))).distinct())
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
