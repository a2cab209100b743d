"""Ranks of sorted rows, counted over all partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airscan.sources.local import bounded, staged


def placed(rows: DataFrame, group: list[str], order: list[Column | str], purpose: str) -> DataFrame:
    """``rows`` with ``place`` (rank from 0 within the group) and ``size`` (rows of the group); a written table.

    Rows are sorted over all partitions by group, then order. Only the counts of each partition and group are summed in
    order, so a group that holds any share of the rows is never one task. Rows equal in all keys are dealt out by their
    number; group columns must not be null.
    """
    keys = [*group, *order, "spare"]
    rows = rows.withColumn("spare", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = staged(rows.drop("spare").withColumn("at", F.monotonically_increasing_id()), purpose)
    part = F.shiftrightunsigned("at", 33).alias("part")
    counts = rows.groupBy(*group, part).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        *(F.col(name).alias(f"{name}_") for name in group), F.col("part").alias("part_"), "first",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), F.sum("n").over(whole).alias("size"),
    )
    counts = staged(counts, purpose)
    same = F.shiftrightunsigned("at", 33) == F.col("part_")
    for name in group:
        same = same & (F.col(name) == F.col(f"{name}_"))
    out = rows.join(bounded(counts), same).withColumn("place", F.col("before") + F.col("at") - F.col("first"))
    return out.drop("at", "first", "before", "part_", *(f"{name}_" for name in group))
