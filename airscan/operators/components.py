"""Connected components of a table of links, by contraction to the smallest node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airscan.sources.local import staged


def _tied(links: DataFrame, upward: bool) -> DataFrame:
    """Tie the neighbours of every node (the larger ones if ``upward``, else the smaller ones) to its smallest neighbour."""
    seen = links.unionByName(links.select(F.col("low").alias("high"), F.col("high").alias("low"))) if upward else links
    seen = seen.withColumnsRenamed({"high": "node", "low": "next"})
    least = seen.groupBy("node").agg(F.least(F.min("next"), F.col("node")).alias("least"))
    least = staged(least, "component-least")
    tied = seen.join(least, "node")
    if upward:
        return tied.filter("next > node").select(F.col("next").alias("high"), F.col("least").alias("low"))
    moved = tied.filter("next > least").select(F.col("next").alias("high"), F.col("least").alias("low"))
    return moved.unionByName(least.select(F.col("node").alias("high"), F.col("least").alias("low")))


def components(links: DataFrame) -> DataFrame:
    """(high, low) for every node of ``links`` (a, b) that is not the smallest of its component, which is ``low``; written.

    Every round is two shuffles of the links; rounds grow with the logarithm of the longest chain. Nothing is held by
    the driver but two numbers, by which a round that changes nothing is told.
    """
    rows = links.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).filter("high > low")
    rows, before = staged(rows.distinct(), "component-links"), None
    while True:
        now = rows.agg(F.count(F.lit(1)), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
        if now == before:
            return rows
        before = now
        for upward in (True, False):
            rows = staged(_tied(rows, upward).filter("high > low").distinct(), "component-links")
