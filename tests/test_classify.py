from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from airscan.gazetteer import LEVELS, Box, box_table, ordered_boxes
from airscan.operators import classify as places
from airscan.operators.normalize import geolocated, no_gps

COUNTRY_ORDER = """singapore israel taiwan belgium switzerland netherlands uae czechia portugal ireland hungary
austria denmark south_korea romania poland greece germany kenya spain vietnam uk nigeria egypt finland thailand
italy malaysia france new_zealand philippines sweden south_africa colombia saudi_arabia norway chile japan mexico
argentina indonesia india australia brazil usa china canada""".split()

# (name, lat, lon, listed country, listed state, area country, area state)
POINTS = [
    ("dallas", 32.78, -96.80, "usa", "texas", "usa", "texas"),
    ("houston", 29.76, -95.37, "usa", "texas", "mexico", None),
    ("new_orleans", 29.95, -90.07, "usa", "louisiana", "mexico", None),
    ("tucson", 32.22, -110.97, "usa", "arizona", "mexico", None),
    ("el_paso", 31.76, -106.49, "usa", "new_mexico", "mexico", None),
    ("toronto", 43.65, -79.38, "usa", "new_york", "usa", "new_york"),
    ("vancouver", 49.28, -123.12, "usa", "us_other", "usa", "us_other"),
    ("providence", 41.82, -71.41, "usa", "massachusetts", "usa", "rhode_island"),
    ("washington", 38.90, -77.03, "usa", "maryland", "usa", "washington_dc"),
    ("new_york", 40.71, -74.00, "usa", "new_jersey", "usa", "new_jersey"),
    ("honolulu", 21.31, -157.86, "other", None, "other", None),
    ("anchorage", 61.22, -149.90, "other", None, "other", None),
    ("juneau", 58.30, -134.42, "canada", None, "canada", None),
    ("seoul", 37.57, 126.98, "china", None, "south_korea", None),
    ("taipei", 25.03, 121.56, "china", None, "taiwan", None),
    ("brussels", 50.85, 4.35, "france", None, "belgium", None),
    ("lisbon", 38.72, -9.14, "spain", None, "portugal", None),
    ("null_island", 0.0, 0.0, "other", None, "other", None),
    ("impossible", 999.0, -999.0, "other", None, "other", None),
]


def points(spark, rows):
    return spark.createDataFrame(rows, "name string, CurrentLatitude double, CurrentLongitude double")


def first_box(lat, lon, boxes, default):
    hits = (b.name for b in boxes if b.lat_min <= lat <= b.lat_max and b.lon_min <= lon <= b.lon_max)
    return next(hits, default)


def edge_points(level, count=3000):
    """Random points, and points exactly on box edges."""
    rng = random.Random(7)
    boxes = LEVELS[level]
    rows = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(count)]
    for box in boxes:
        rows += [(lat, lon) for lat in (box.lat_min, box.lat_max) for lon in (box.lon_min, box.lon_max)]
        rows += [(rng.uniform(box.lat_min, box.lat_max), rng.uniform(box.lon_min, box.lon_max)) for _ in range(20)]
        rows += [(box.lat_max + 1e-9, box.lon_min), (box.lat_min, box.lon_min - 1e-9)]
    return [(str(i), lat, lon) for i, (lat, lon) in enumerate(rows)]


def test_sizes_and_area_order():
    assert [len(LEVELS[level]) for level in ("region", "country", "us_state")] == [4, 47, 51]
    assert [box.name for box in ordered_boxes("country")] == COUNTRY_ORDER
    states = [box.name for box in ordered_boxes("us_state")]
    assert states[:8] == ["washington_dc", "rhode_island", "delaware", "connecticut", "vermont", "new_jersey", "new_hampshire", "massachusetts"]
    assert states[-5:] == ["montana", "michigan", "california", "texas", "alaska"]


def test_box_table_ranks(spark):
    rows = box_table(spark, "us_state").orderBy("rank").collect()
    assert [row.name for row in rows] == [box.name for box in ordered_boxes("us_state")]
    assert [row.area for row in rows] == sorted(row.area for row in rows)


@pytest.mark.parametrize("order,column", [("listed", 3), ("area", 5)])
def test_golden_points(spark, order, column):
    rows = points(spark, [p[:3] for p in POINTS])
    got = {r.name: (r.country, r.state) for r in places.classify_country_state(rows, order).collect()}
    assert got == {p[0]: (p[column], p[column + 1]) for p in POINTS}


def test_states_first_reaches_alaska_and_hawaii(spark):
    rows = points(spark, [p[:3] for p in POINTS])
    got = {r.name: (r.country, r.state) for r in places.classify_country_state(rows, states_first=True).collect()}
    assert got["honolulu"] == ("usa", "hawaii") and got["anchorage"] == ("usa", "alaska")
    assert got["houston"] == ("usa", "texas") and got["seoul"] == ("south_korea", None)


@pytest.mark.parametrize("level", ["region", "country", "us_state"])
@pytest.mark.parametrize("order", ["listed", "area"])
def test_classify_equals_linear_search(spark, level, order):
    rows = edge_points(level)
    boxes = ordered_boxes(level, order)
    want = {name: first_box(lat, lon, boxes, "other") for name, lat, lon in rows}
    got = {r.name: r.region for r in places.classify(points(spark, rows), level, order).collect()}
    assert got == want


def test_all_matches_equals_linear_search(spark):
    rows = edge_points("country", 500)
    boxes = ordered_boxes("country")
    want = sorted(
        (name, box.name, rank)
        for name, lat, lon in rows
        for rank, box in enumerate(boxes, 1)
        if first_box(lat, lon, [box], None)
    )
    got = places.all_matches(points(spark, rows), "country").collect()
    assert sorted((r.name, r.region, r.box_rank) for r in got) == want


def test_many_boxes_use_wider_cells(spark):
    boxes = tuple(Box(f"b{i}", -80.0 + i / 100, 80.0, -170.0, 170.0 - i / 100) for i in range(50))
    assert places.cell_size(boxes) > 1.0
    rows = edge_points("region", 200)
    got = {r.name: r.region for r in places.classify(points(spark, rows), boxes, "listed").collect()}
    assert got == {name: first_box(lat, lon, boxes, "other") for name, lat, lon in rows}


def test_lookup_does_not_shuffle_points(spark):
    plan = places.classify_country_state(points(spark, [p[:3] for p in POINTS]))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_geo_split_is_a_partition(spark):
    rows = points(spark, [("a", 1.0, 1.0), ("b", None, 1.0), ("c", 1.0, None), ("d", None, None)])
    assert [r.name for r in geolocated(rows).collect()] == ["a"]
    assert sorted(r.name for r in no_gps(rows).collect()) == ["b", "c", "d"]
    assert geolocated(rows).filter(F.col("CurrentLatitude").isNull()).count() == 0


def mixed_boxes(rng, small, wide):
    boxes = []
    for i in range(small):
        lat, lon, side = rng.uniform(-80, 75), rng.uniform(-170, 160), rng.choice([0.02, 0.1, 0.5, 3])
        boxes.append(Box(f"b{i}", lat, lat + side, lon, lon + side))
    return boxes + [Box(f"w{i}", -60 - i / 100, 60.0, -150.0, 150.0 + i / 100) for i in range(wide)]


def searched(points, boxes):
    edges = np.array([b[1:] for b in boxes])
    out = {}
    for i, lat, lon in points:
        inside = [] if lat is None else np.flatnonzero(
            (edges[:, 0] <= lat) & (lat <= edges[:, 1]) & (edges[:, 2] <= lon) & (lon <= edges[:, 3]))
        out[i] = [boxes[k].name for k in inside]
    return out


@pytest.mark.parametrize("order", ["listed", "area"])
def test_many_boxes_of_mixed_size(spark, monkeypatch, order):
    """A hundred thousand boxes: short lists, no shuffle of points while the cells are few, equal to a plain search."""
    rng = random.Random(4)
    boxes = ordered_boxes(tuple(mixed_boxes(rng, 100_000, 1500)), order)
    rows = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(2000)] + [(3000, None, None), (3001, 89.9, 0.0)]
    rows += [(4000 + i, boxes[i].lat_min, boxes[i].lon_max) for i in range(0, 2000, 40)]
    frame = spark.createDataFrame(rows, "id long, CurrentLatitude double, CurrentLongitude double")
    tables, longest, entries = places.cut_cells((("region", tuple(boxes)),), True)
    assert longest["region"] <= places.LEAF and len(tables) > 2 and entries < 20 * len(boxes)
    want = {i: (names or ["other"])[0] for i, names in searched(rows, boxes).items()}
    got = places.classify(frame, boxes, "listed")
    assert got._jdf.queryExecution().toString().count("CASE WHEN") < 50
    assert {r.id: r.region for r in got.collect()} == want


def test_cut_cells_equal_cells_of_one_size(spark, monkeypatch):
    rng = random.Random(5)
    boxes = mixed_boxes(rng, 300, 300)
    rows = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(1000)]
    frame = spark.createDataFrame(rows, "id long, CurrentLatitude double, CurrentLongitude double")
    want = searched(rows, boxes)
    for entries in (0, places.TREE_ENTRIES):
        monkeypatch.setattr(places, "TREE_ENTRIES", entries)
        places._cut_frames.cache_clear()
        got = places.classify(frame, boxes, "listed")
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert entries or "strategy=broadcast" not in plan
        assert {r.id: r.region for r in got.collect()} == {i: (names or ["other"])[0] for i, names in want.items()}
        if entries:
            continue
        every = places.all_matches(frame, boxes, "listed").collect()
        assert sorted((r.id, r.region) for r in every) == sorted((i, name) for i, names in want.items() for name in names)
