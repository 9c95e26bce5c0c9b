"""Connected components of a graph given as links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.plans.staging import staged


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _pointed(links: DataFrame, larger_only: bool) -> DataFrame:
    """Every neighbour of a node is linked to the smallest among the node and its neighbours.

    The smallest neighbour is found by a sum with partial results; a node of very many neighbours
    is one row on one side of the join, whose other side Spark can split.
    """
    seen = _both_ways(links) if larger_only else links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = seen.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    joined = seen.join(least, "u")
    if larger_only:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            joined.select(F.col("u"), F.col("m").alias("v"))
        )
    return moved.where("u <> v").distinct()


def _settled(links: DataFrame) -> bool:
    """Whether every node has one link at most and none that is linked to is linked itself."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(
        links.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    )
    sums = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return sums.where("out > 1 or (out = 1 and into = 1)").limit(1).count() == 0


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (``u, v``): the smallest node it reaches.

    Large stars and small stars alternate (Kiveris and others, 2014) until every node is linked to the
    smallest of its component and to nothing else; each round writes its links to the shared folder.
    Nulls and links of a node to itself are left out.
    """
    ordered = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    current = staged(ordered.distinct())
    while not _settled(current):
        current = staged(_pointed(staged(_pointed(current, True)), False))
    tops = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(tops)
