"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatmetrics.llm.common import release, written


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component): the smallest node that links (a, b) reach, for linked nodes.

    Links with a null end and of a node with itself count for nothing.
    """
    found = joined(links)
    return found.union(
        found.select(F.col("component").alias("node"), "component").distinct()
    )


def joined(links: DataFrame) -> DataFrame:
    """The rows of :func:`components` without those of the smallest nodes themselves.

    Alternates large and small stars until the links are stars around the
    smallest nodes; the number of rounds grows with the logarithm of the
    number of nodes, and links that are such stars already need none.  Both
    halves of a round are written to the shared folder, so that plans stay
    short and a lost executor costs one round at most.
    """
    edges = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    edges = written(edges.distinct(), "links")
    while not _are_stars(edges):
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.where("v > u")
            .join(least.select("u", F.least("u", "m").alias("m")), "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        large = written(large, "links")
        heads = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(heads, "u")
            .where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(heads)
            .distinct()
        )
        new = written(small, "links")
        release(edges, large)
        edges = new
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _are_stars(edges: DataFrame) -> bool:
    """Whether of distinct links (u, v) with u > v each u has one, and is no other's v."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("low")).union(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("low"))
    )
    sums = ends.groupBy("node").agg(F.sum("low").alias("links"), F.min("low").alias("least"))
    return sums.where("links > 1 OR links > least").isEmpty()
