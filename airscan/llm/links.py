"""Connected components of a link table, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airscan.sources.local import staged


def checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def star(edges: DataFrame, large: bool) -> DataFrame:
    """One large or small star step over edges u > v: neighbours are tied to the smallest node they share.

    The smallest neighbours are written before the join, so that Spark sees two plain shuffles and can split the
    rows of a node with very many neighbours.
    """
    if large:
        edges = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = staged(edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "links-least")
    tied = edges.join(least, "u")
    if large:
        return tied.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        least.select("u", F.col("m").alias("v"))
    )


def components(links: DataFrame) -> DataFrame:
    """(u, v) for every linked node u that is not the smallest of its component: v is the smallest, a written table."""
    ordered = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v")
    edges = staged(ordered.distinct(), "links")
    before = None
    while (now := checksum(edges)) != before:
        before = now
        for large in (True, False):
            edges = staged(star(edges, large).filter("u != v").distinct(), "links")
    return edges
