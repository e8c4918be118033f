"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed


def _written(ends: DataFrame) -> DataFrame:
    """The smallest v of every u, as a table: a join with it can split the rows of a hub,
    one with the aggregate itself could not."""
    return checkpointed(ends.groupBy("u").agg(F.min("v").alias("low")), "minima")


def _large_star(edges: DataFrame) -> DataFrame:
    """Neighbours above a node are tied to the smallest neighbour of the node."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _written(both).withColumn("low", F.least("u", "low"))
    tied = both.join(low, "u").filter("v > u")
    return tied.select(F.col("v").alias("u"), F.col("low").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below are tied to the smallest of these."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _written(down)
    tied = down.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return tied.union(low.select("u", F.col("low").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (u, v); the smallest node names one.

    Minima combine map-side and are joined back, so no task gathers the neighbours
    of a node. Every round is written to the shared folder.
    """
    def tidy(rows: DataFrame) -> DataFrame:
        return checkpointed(rows.filter("u <> v").distinct(), "stars")

    def settled(rows: DataFrame) -> bool:
        """Whether every node has one edge, to a node that has none of its own."""
        ends = rows.select(F.col("u").alias("n"), F.lit(1).alias("own"), F.lit(0).alias("root")).union(
            rows.select("v", F.lit(0), F.lit(1)))
        nodes = ends.groupBy("n").agg(F.sum("own").alias("own"), F.max("root").alias("root"))
        return nodes.filter("own > 1 OR own + root > 1").isEmpty()

    # Edges point to the smaller node, so the root of a star is its smallest.
    stars = tidy(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    while not settled(stars):
        stars = tidy(_small_star(tidy(_large_star(stars))))
    roots = stars.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
