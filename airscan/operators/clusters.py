"""Clusters of sightings in space and time, and the detector's report per log, cluster and time window.

A cell is a square of degrees and a slot of time. Clusters are found among the occupied cells of a log as by DBSCAN with
the distance of one cell in any direction: a cell is dense if it and the cells around it hold ``cluster_min`` sightings,
dense cells that touch are one cluster, and another occupied cell that touches a cluster belongs to it (to the smallest,
where it touches several). A gap longer than a slot ends a cluster, so sessions at one place are told apart.

Sightings are counted per cell before anything is linked. Cells that touch share a corner, so links are drawn within the
few cells around each corner and no pair of cells is ever formed twice. Columns wrap at the date line.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airscan.operators.components import components
from airscan.operators.signals import (
    DEFAULTS,
    Thresholds,
    burst_scores,
    combined_signals,
    gps_churn,
    name_measures,
    name_tallies,
    new_per_tick,
    window_start,
)
from airscan.operators.templates import template_masks, template_names
from airscan.schema import LAT, LON, MAC
from airscan.sources.local import staged

CELL = ["x", "y", "t"]


def columns_around(limits: Thresholds) -> int:
    return math.ceil(360 / limits.cluster_deg)


def cell_of(lat: Column, lon: Column, ts: Column, limits: Thresholds = DEFAULTS) -> list[Column]:
    """Column, row and slot of a sighting; null without position or time."""
    x = F.floor(F.pmod(lon + 180, F.lit(360.0)) / limits.cluster_deg)
    y = F.floor((lat + 90) / limits.cluster_deg)
    t = F.floor(F.unix_seconds(ts.cast("timestamp")) / limits.cluster_slot_s)
    placed = lat.isNotNull() & lon.isNotNull() & ts.isNotNull()
    return [F.when(placed, value).alias(name) for name, value in zip(CELL, (x, y, t), strict=True)]


def occupied(df: DataFrame, log: str, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Occupied cells of every log with their sightings ``n``."""
    cells = df.select(log, *cell_of(F.col(LAT), F.col(LON), F.col("ts"), limits)).filter("x is not null")
    return cells.groupBy(log, *CELL).agg(F.count("*").alias("n"))


def _around(cells: DataFrame, steps: tuple[int, ...], limits: Thresholds) -> DataFrame:
    """Every cell handed to the places a step away in each direction."""
    offsets = F.array(*[F.struct(*(F.lit(d).alias(f"d{n}") for n, d in zip(CELL, (i, j, k), strict=True)))
                        for i in steps for j in steps for k in steps])
    moved = cells.withColumn("_d", F.explode(offsets))
    return moved.withColumns({
        "x": F.pmod(F.col("x") + F.col("_d.dx"), F.lit(columns_around(limits))),
        "y": F.col("y") + F.col("_d.dy"), "t": F.col("t") + F.col("_d.dt"),
    }).drop("_d")


def clusters(cells: DataFrame, log: str, limits: Thresholds = DEFAULTS) -> DataFrame:
    """(log, x, y, t, cluster) for the cells that belong to a cluster, named by slot, row and column of its first dense cell.

    ``cells`` are those of :func:`occupied`; the result is a written table.
    """
    cells = staged(cells.groupBy(log, *CELL).agg(F.sum("n").alias("n")), "cluster-cells")
    counted = _around(cells, (-1, 0, 1), limits).groupBy(log, *CELL).agg(F.sum("n").alias("near"))
    # A null log is a log of its own, as in any grouping.
    same = [F.col(f"o.{log}").eqNullSafe(F.col(f"c.{log}")), *(F.col(f"o.{n}") == F.col(f"c.{n}") for n in CELL)]
    dense = cells.alias("o").join(counted.filter(F.col("near") >= limits.cluster_min).alias("c"), same, "left_semi")
    dense = staged(dense.select(log, *CELL).withColumn("cell", F.monotonically_increasing_id()), "cluster-dense")
    corners = _around(dense, (0, 1), limits).groupBy(log, *CELL).agg(F.collect_set("cell").alias("met"))
    met = corners.filter(F.size("met") > 1).withColumn("least", F.array_min("met"))
    tied = components(met.select(F.explode("met").alias("a"), F.col("least").alias("b")))
    grouped = dense.join(tied, F.col("cell") == F.col("high"), "left").withColumn("group", F.coalesce("low", "cell"))
    grouped = staged(grouped.select(log, *CELL, "group"), "cluster-groups")
    first = grouped.groupBy("group").agg(F.min(F.struct("t", "y", "x")).alias("first"))
    named = grouped.join(first, "group").select(log, *CELL, "first")
    joined = _around(named, (-1, 0, 1), limits).groupBy(log, *CELL).agg(F.min("first").alias("first"))
    found = cells.alias("o").join(joined.alias("c"), same)
    name = F.concat_ws(":", "first.t", "first.y", "first.x")
    return staged(found.select(f"o.{log}", *(f"o.{n}" for n in CELL), name.alias("cluster")), "clusters")


def with_cluster(df: DataFrame, found: DataFrame, log: str, cell: list[Column]) -> DataFrame:
    """Add ``cluster``: that of the row's cell, null outside all clusters or without position."""
    other = found.select(F.col(log).alias("_log"), *(F.col(n).alias(f"_{n}") for n in CELL), "cluster")
    keyed = df.withColumn("_cell", F.struct(*cell))
    same = [F.col(log).eqNullSafe(F.col("_log")), *(F.col(f"_cell.{n}") == F.col(f"_{n}") for n in CELL)]
    return keyed.join(other, same, "left").drop("_log", "_cell", *(f"_{n}" for n in CELL))


def where(log: str) -> Column:
    """Log and cluster as one key."""
    return F.struct(F.col(log).alias("log"), "cluster").alias("where")


def cluster_bursts(first: DataFrame, log: str, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Ticks scored against their log, for every cluster that has new devices in the tick; ``first`` has ``cluster``."""
    scored = burst_scores(new_per_tick(first, log, limits.burst_tick_s), log, limits)
    ticks = F.floor(F.unix_seconds(F.col("first_ts").cast("timestamp")) / limits.burst_tick_s)
    here = first.filter("first_ts is not null").select(F.col(log).alias("_log"), ticks.alias("_tick"), "cluster").distinct()
    both = scored.join(here, F.col(log).eqNullSafe(F.col("_log")) & (F.col("tick") == F.col("_tick")))
    return both.withColumn("where", where(log)).drop("_log", "_tick")


def cluster_signals(df: DataFrame, phrases: DataFrame, log: str, limits: Thresholds = DEFAULTS) -> DataFrame:
    """All five modules per log, cluster (``where``) and time window in the long form.

    Names are tallied within the cluster. New devices are scored against the whole log and moves between all its fixes;
    a tick counts for the clusters with new devices in it, a move for the cluster it ends in.
    """
    found = clusters(occupied(df, log, limits), log, limits)
    cell = cell_of(F.col(LAT), F.col(LON), F.col("ts"), limits)
    rows = with_cluster(df, found, log, cell).withColumn("where", where(log))
    rows = staged(rows.withColumn("window_start", window_start(size=limits.window)), "cluster-sightings")
    keys = ["where", "window_start"]
    tallies = name_measures(rows, phrases, limits).groupBy(*keys).agg(*name_tallies())
    numbered = template_names(template_masks(rows, keys), keys, limits)
    at = F.struct("ts", "cluster")
    first = rows.groupBy(log, MAC).agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.min_by("cluster", at).alias("cluster")
    )
    steps = with_cluster(gps_churn(df, log, limits), found, log, cell_of(F.col("lat"), F.col("lon"), F.col("ts"), limits))
    return combined_signals(
        tallies, numbered, cluster_bursts(first, log, limits), steps.withColumn("where", where(log)), "where", limits
    )


def by_cluster(reported: DataFrame, log: str) -> DataFrame:
    """A report by ``where`` with log and cluster as columns."""
    return reported.select(F.col("where.log").alias(log), "where.cluster", "*").drop("where")
