"""Connected components of a table of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import cut


def are_stars(edges: DataFrame) -> bool:
    """Whether each node of the links u > v has either one link to a smaller node and no other, or links to larger ones only."""
    up = F.struct(F.col("u").alias("node"), F.lit(1).alias("up"))
    down = F.struct(F.col("v").alias("node"), F.lit(0).alias("up"))
    ends = edges.select(F.explode(F.array(up, down)).alias("end")).select("end.*")
    return ends.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least")).filter("ups > 1 OR ups = 1 AND least = 0").isEmpty()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (smallest node reachable) for every node with a link.

    Rounds of large stars and small stars: each node hands its larger neighbours, then its smaller ones, to the smallest it
    knows. Links turn into stars around the smallest node of a component in a number of rounds that grows with the
    logarithm of the nodes; once they are stars, no round follows. Groupings take minima only, so a node with any number of
    links is pre-aggregated and no list of neighbours is ever held.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    edges = cut(edges)
    while not are_stars(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # Large star: every larger neighbour of u goes to the least that u knows, u itself included.
        large = edges.select(F.col("v").alias("u"), F.col("u").alias("v")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        # Small star: u and its smaller neighbours go to the least of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        edges = cut(small)
    # A star: every node but the smallest has one link, to the smallest.
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
