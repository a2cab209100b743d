"""Point-in-box classification.

Every point is looked up by its grid cell.  The cell table says which boxes can
contain a point of that cell, in evaluation order and cut off after the first box
that covers the whole cell, so each point is compared with a handful of boxes instead
of all of them.  Its row count follows from the box list alone and is known before the
job starts.  Up to ``MAX_CELLS`` rows, with as wide a cell as that takes, it is a local
table joined by broadcast and the points are not shuffled.

Where boxes of very different sizes would leave long lists in wide cells, or there are too many boxes, cells are cut
further instead: a cell with more than ``LEAF`` boxes to try is cut into sixteen, each with the boxes that touch it, up to
the first that covers it.  Points look for their cell once per cell size in use, and each finds one.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airscan.gazetteer import OTHER, US_OTHER, Box, ordered_boxes
from airscan.schema import LAT, LON
from airscan.sources.local import beside, helper, staged

MAX_CELLS = 100_000
TREE_ENTRIES = 400_000  # boxes in all lists up to which the cut cells are broadcast
LEAF = 16
HIDDEN = 4000  # boxes of a cell up to which those hidden by one earlier box are looked for
ROOT, SMALLEST, CUT = 64.0, 64.0 / 4**8, 4  # powers of two keep the division exact
EVERY, LEAST_EVERY = 256, 1.0  # where every match counts, lists are as long as the answers, and cells are cut less
LONGEST = 64  # boxes of a cell beyond which cells of one size will not do
CELL_SIZES = (1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0)  # powers of two keep the division exact
UNROLLED = 16  # boxes of a cell up to which they are tried in compiled code one by one

_EDGES = ("lat_min", "lat_max", "lon_min", "lon_max")
_BOX_TYPE = pa.struct([("rank", pa.int64()), ("name", pa.string())] + [(edge, pa.float64()) for edge in _EDGES])


def in_box(lat: Column, lon: Column, box: Column | Box) -> Column:
    """Inclusive containment on all four sides."""
    if isinstance(box, Box):
        return lat.between(box.lat_min, box.lat_max) & lon.between(box.lon_min, box.lon_max)
    return lat.between(box["lat_min"], box["lat_max"]) & lon.between(box["lon_min"], box["lon_max"])


def _cells_of(box: Box, size: float):
    for row in range(math.floor(box.lat_min / size), math.floor(box.lat_max / size) + 1):
        for col in range(math.floor(box.lon_min / size), math.floor(box.lon_max / size) + 1):
            yield row, col


def _covers(box: Box, cell: tuple[int, int], size: float) -> bool:
    row, col = cell
    return (
        box.lat_min <= row * size
        and (row + 1) * size <= box.lat_max
        and box.lon_min <= col * size
        and (col + 1) * size <= box.lon_max
    )


def _count_cells(boxes: Sequence[Box], size: float) -> int:
    return sum(
        (math.floor(b.lat_max / size) - math.floor(b.lat_min / size) + 1)
        * (math.floor(b.lon_max / size) - math.floor(b.lon_min / size) + 1)
        for b in boxes
    )


def cell_size(boxes: Sequence[Box]) -> float | None:
    """Smallest offered cell for which the cell table stays below ``MAX_CELLS``, if there is one."""
    return next((size for size in CELL_SIZES if _count_cells(boxes, size) <= MAX_CELLS), None)


def _ranked(boxes: Sequence[Box]) -> dict[Box, int]:
    return {box: rank for rank, box in enumerate(boxes, 1)}


@lru_cache(maxsize=32)
def candidate_cells(
    levels: tuple[tuple[str, tuple[Box, ...]], ...], first_only: bool
) -> tuple[pa.Table, dict[str, int], float]:
    """Cells with, per level, the boxes to try in order; the longest list per level; the cell size."""
    size = cell_size([box for _, boxes in levels for box in boxes])
    ranks = {level: _ranked(boxes) for level, boxes in levels}
    cells: dict[tuple[int, int], dict[str, list[Box]]] = {}
    for level, boxes in levels:
        for box in boxes:
            for cell in _cells_of(box, size):
                tries = cells.setdefault(cell, {}).setdefault(level, [])
                if not (first_only and tries and _covers(tries[-1], cell, size)):
                    tries.append(box)
    keys = list(cells)
    columns = {
        "_row": pa.array([row for row, _ in keys], pa.int64()),
        "_col": pa.array([col for _, col in keys], pa.int64()),
    }
    longest = {}
    for level, _ in levels:
        lists = [cells[key].get(level) for key in keys]
        longest[level] = max((len(tries) for tries in lists if tries), default=0)
        columns[f"_{level}_boxes"] = pa.array(
            [tries and [{"rank": ranks[level][box], **box._asdict()} for box in tries] for tries in lists],
            pa.list_(_BOX_TYPE),
        )
    return pa.table(columns), longest, size


def _touching(edges: np.ndarray, size: float, row: int, col: int) -> np.ndarray:
    """Which boxes hold a point of a cell; its upper edges belong to the next one."""
    low_lat, low_lon = row * size, col * size
    return (
        (edges[:, 0] < low_lat + size) & (edges[:, 1] >= low_lat) & (edges[:, 2] < low_lon + size) & (edges[:, 3] >= low_lon)
    )


def _covering(edges: np.ndarray, size: float, row: int, col: int) -> np.ndarray:
    low_lat, low_lon = row * size, col * size
    return (
        (edges[:, 0] <= low_lat) & (edges[:, 1] >= low_lat + size) & (edges[:, 2] <= low_lon) & (edges[:, 3] >= low_lon + size)
    )


def _not_hidden(edges: np.ndarray, size: float, row: int, col: int) -> np.ndarray:
    """Which boxes, in order, reach a part of the cell that no single earlier box holds."""
    low = np.array([row * size, row * size, col * size, col * size])
    inside = np.clip(edges, low, low + size)
    left = np.arange(len(edges))
    kept = []
    while len(left):
        first, rest = inside[left[0]], inside[left[1:]]
        kept.append(left[0])
        hidden = (rest[:, 0] >= first[0]) & (rest[:, 1] <= first[1]) & (rest[:, 2] >= first[2]) & (rest[:, 3] <= first[3])
        left = left[1:][~hidden]
    return np.array(kept, int)


@lru_cache(maxsize=8)
def cut_cells(
    levels: tuple[tuple[str, tuple[Box, ...]], ...], first_only: bool
) -> tuple[dict[float, pa.Table], dict[str, int], int]:
    """Cells cut until their lists are short: a table per cell size, the longest list per level, boxes in all lists."""
    names = [level for level, _ in levels]
    edges = [np.array([[getattr(box, edge) for edge in _EDGES] for box in boxes], float).reshape(-1, 4) for _, boxes in levels]
    roots = {cell for found in edges for low_lat, high_lat, low_lon, high_lon in np.unique(found // ROOT, axis=0).astype(int)
             for cell in ((r, c) for r in range(low_lat, high_lat + 1) for c in range(low_lon, high_lon + 1))}
    todo = [(ROOT, row, col, [np.arange(len(found)) for found in edges]) for row, col in sorted(roots)]
    leaves: dict[float, list] = {}
    while todo:
        size, row, col, tries = todo.pop()
        here = []
        for found, chosen in zip(edges, tries, strict=True):
            chosen = chosen[_touching(found[chosen], size, row, col)]
            if first_only and len(chosen):
                covering = _covering(found[chosen], size, row, col)
                chosen = chosen[: covering.argmax() + 1] if covering.any() else chosen
                if LEAF < len(chosen) <= HIDDEN:
                    chosen = chosen[_not_hidden(found[chosen], size, row, col)]
            here.append(chosen)
        most = max(map(len, here))
        if not most:
            continue
        if most <= (LEAF if first_only else EVERY) or size <= (SMALLEST if first_only else LEAST_EVERY):
            leaves.setdefault(size, []).append((row, col, here))
            continue
        if not first_only:  # boxes that cover the whole cell are listed here once, not in every cell below
            over = [_covering(found[chosen], size, row, col) for found, chosen in zip(edges, here, strict=True)]
            if any(map(np.any, over)):
                leaves.setdefault(size, []).append((row, col, [chosen[x] for chosen, x in zip(here, over, strict=True)]))
            here = [chosen[~x] for chosen, x in zip(here, over, strict=True)]
        todo += [(size / CUT, row * CUT + i, col * CUT + j, here) for i in range(CUT) for j in range(CUT)]
    longest, entries, tables = dict.fromkeys(names, 0), 0, {}
    for size, cells in leaves.items():
        columns = {"_row": pa.array([row for row, _, _ in cells], pa.int64()), "_col": pa.array([col for _, col, _ in cells], pa.int64())}
        for k, (level, boxes) in enumerate(levels):
            lists = [here[k] for _, _, here in cells]
            columns[f"_{level}_boxes"] = _box_lists(boxes, edges[k], lists)
            longest[level] = max(longest[level], *map(len, lists))
            entries += sum(map(len, lists))
        tables[size] = pa.table(columns)
    return tables, longest, entries


def _box_lists(boxes: Sequence[Box], edges: np.ndarray, lists: list[np.ndarray]) -> pa.Array:
    """Lists of boxes, each given by its place in the order."""
    flat = np.concatenate(lists)
    names = pa.array([box.name for box in boxes], pa.string()).take(pa.array(flat))
    fields = [pa.array(flat + 1, pa.int64()), names, *(pa.array(edges[flat, i]) for i in range(len(_EDGES)))]
    ends = np.cumsum([0, *map(len, lists)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(_BOX_TYPE)))


class Cells(NamedTuple):
    """Cell tables by cell size, and the longest list per level; ``attach`` gives points the lists of their cell."""

    tables: dict[float, DataFrame]
    longest: dict[str, int]

    def attach(self, df: DataFrame, how: str, lat: str = LAT, lon: str = LON) -> DataFrame:
        """Points outside every cell get nulls (``left``) or are dropped (``inner``)."""
        names = [f"_{level}_boxes" for level in self.longest]
        if len(self.tables) == 1:
            ((size, table),) = self.tables.items()
            cell = {"_row": F.floor(F.col(lat) / size), "_col": F.floor(F.col(lon) / size)}
            return df.withColumns(cell).join(table, ["_row", "_col"], how).drop("_row", "_col")
        for k, (size, table) in enumerate(sorted(self.tables.items())):
            table = table.withColumnsRenamed({name: f"{name}_{k}" for name in ["_row", "_col", *names]})
            here = (F.floor(F.col(lat) / size) == F.col(f"_row_{k}")) & (F.floor(F.col(lon) / size) == F.col(f"_col_{k}"))
            df = df.join(table, here, "left").drop(f"_row_{k}", f"_col_{k}")
        none = F.array().cast(_LIST_SQL)
        lists = {name: F.concat(none, *(F.coalesce(F.col(f"{name}_{k}"), none) for k in range(len(self.tables)))) for name in names}
        df = df.withColumns(lists).drop(*(f"{name}_{k}" for name in names for k in range(len(self.tables))))
        return df.filter(" or ".join(f"size({name}) > 0" for name in names)) if how == "inner" else df


_LIST_SQL = "array<struct<rank: bigint, name: string, lat_min: double, lat_max: double, lon_min: double, lon_max: double>>"


@lru_cache(maxsize=32)
def _cell_frame(spark: SparkSession, levels: tuple, first_only: bool) -> DataFrame:
    return F.broadcast(spark.createDataFrame(candidate_cells(levels, first_only)[0]))


@lru_cache(maxsize=8)
def _cut_frames(spark: SparkSession, levels: tuple, first_only: bool) -> dict[float, DataFrame]:
    """The cut cells; broadcast while their lists together are short enough, else written and joined by cell."""
    tables, _, entries = cut_cells(levels, first_only)
    frames = {size: spark.createDataFrame(table) for size, table in tables.items()}
    if entries <= TREE_ENTRIES:
        return {size: F.broadcast(frame) for size, frame in frames.items()}
    return {size: staged(frame, "cells") for size, frame in frames.items()}


def cell_table(spark: SparkSession, levels: dict[str, Sequence[Box]], first_only: bool = True) -> Cells:
    """The cell tables of some levels.

    With ``first_only`` a list may end at the first box covering its whole cell, since no
    later box can win there.
    """
    key = tuple((level, tuple(boxes)) for level, boxes in levels.items())
    if cell_size([box for boxes in levels.values() for box in boxes]) is not None:
        _, longest, size = candidate_cells(key, first_only)
        if max(longest.values()) <= LONGEST:
            return Cells({size: _cell_frame(spark, key, first_only)}, longest)
    tables, longest, _ = cut_cells(key, first_only)
    return Cells(_cut_frames(spark, key, first_only) if tables else {}, longest)


def first_match(lat: str, lon: str, boxes: str, longest: int) -> Column:
    """Name of the first box of an ordered candidate list that contains the point, or null."""
    if longest > UNROLLED:
        inside = F.filter(F.col(f"`{boxes}`"), lambda box: in_box(F.col(f"`{lat}`"), F.col(f"`{lon}`"), box))
        return F.get(inside, F.lit(0))["name"]
    tries = [f"get(`{boxes}`, {i})" for i in range(longest)]
    cases = " ".join(
        f"WHEN `{lat}` BETWEEN {box}.lat_min AND {box}.lat_max AND `{lon}` BETWEEN {box}.lon_min AND {box}.lon_max "
        f"THEN {box}.name"
        for box in tries
    )
    return F.expr(f"CASE {cases} END") if tries else F.lit(None).cast("string")


def classify(
    df: DataFrame,
    level: str | Sequence[Box],
    order: str = "area",
    out: str = "region",
    default: str = OTHER,
    lat: str = LAT,
    lon: str = LON,
) -> DataFrame:
    """Add the first matching box name of one level; an input column of that name is kept as ``<name>_input``."""
    df = beside(df, out)
    cells = cell_table(df.sparkSession, {out: ordered_boxes(level, order)})
    found = first_match(lat, lon, f"_{out}_boxes", cells.longest[out])
    joined = cells.attach(df, "left", lat, lon)
    return joined.withColumn(out, helper(F.coalesce(found, F.lit(default)), out)).drop(f"_{out}_boxes")


def classify_v1_region(df: DataFrame) -> DataFrame:
    """Four coarse regions in listed order, else ``other``."""
    return classify(df, "region", "listed", "region")


def classify_country_state(df: DataFrame, order: str = "area", states_first: bool = False) -> DataFrame:
    """Add ``country`` and, for USA points, ``state`` in one lookup; input columns of those names are kept as ``<name>_input``.

    A state is only looked for inside the USA box, so Alaska and Hawaii are never
    found unless ``states_first`` lets a state box decide the country as well.
    """
    df = beside(df, "country", "state")
    levels = {"country": ordered_boxes("country", order), "state": ordered_boxes("us_state", order)}
    cells = cell_table(df.sparkSession, levels)
    state = first_match(LAT, LON, "_state_boxes", cells.longest["state"])
    country = F.coalesce(first_match(LAT, LON, "_country_boxes", cells.longest["country"]), F.lit(OTHER))
    joined = cells.attach(df, "left")
    if states_first:
        joined = joined.withColumn("state", state)
        country = F.when(F.col("state").isNotNull(), "usa").otherwise(country)
        state = F.col("state")
    joined = joined.withColumn("country", helper(country, "country"))
    state = F.when(F.col("country") == "usa", F.coalesce(state, F.lit(US_OTHER)))
    return joined.withColumn("state", helper(state, "state")).drop("_country_boxes", "_state_boxes")


def all_matches(
    df: DataFrame, level: str | Sequence[Box], order: str = "area", out: str = "region"
) -> DataFrame:
    """One row per point and containing box, with the box's evaluation rank; explains overlaps."""
    df = beside(df, out, "box_rank")
    cells = cell_table(df.sparkSession, {out: ordered_boxes(level, order)}, first_only=False)
    return (
        cells.attach(df, "inner")
        .withColumn("_box", F.explode(f"_{out}_boxes"))
        .filter(in_box(F.col(LAT), F.col(LON), F.col("_box")))
        .withColumns({out: helper(F.col("_box.name"), out), "box_rank": helper(F.col("_box.rank"), "box_rank")})
        .drop("_box", f"_{out}_boxes")
    )
