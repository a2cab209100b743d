"""Names from templates, and clusters of sightings against a plain search."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from airscan.functions.text import one_less
from airscan.operators import clusters, signals, templates
from airscan.operators.phrases import phrase_list

START = datetime(2024, 1, 1)


def seen(spark, names, log="a"):
    rows = [(log, name, START + timedelta(seconds=i)) for i, name in enumerate(names)]
    return spark.createDataFrame(rows, "log string, SSID string, ts timestamp")


def tripped(spark, names):
    found = templates.templates(seen(spark, names), "log").filter("tripped")
    return {(r.kind, r.prefix) for r in found.collect()}


CLEAN = [
    "2.4G home", "5G home", "7-eleven", "24 hour gym", "TP-Link_A3F2", "TP-Link_0001", "TP-Link_9B10", "cafe", "beef", "bad",
    "linksys", "NETGEAR55", "1 Main St", "2 King Rd", "DIRECT-4E-printer", "", None, "ünïcode 3", "{} 7", "360",
]


def test_clean_names_trip_nothing(spark):
    assert tripped(spark, CLEAN) == set()


@pytest.mark.parametrize(
    ("names", "want"),
    [
        ([f"{i} cars left" for i in range(7, 11)], ("number", "{} cars left")),
        ([f"{i:03d}-Net" for i in range(97, 102)], ("number", "{}-net")),
        ([f"Floor {i}  Guest 5G" for i in (3, 9, 20, 50, 77)], ("number", "floor {} guest 5g")),
        ([f"net{i}" for i in range(4)], ("number", "net{}")),
        ([f"cam-{i:02x}" for i in range(14, 18)], ("hex", "cam-{}")),
        ([f"CAM_{i:X}_x" for i in range(0xFE, 0x102)], ("hex", "cam_{}_x")),
        ([f"{i:02d} {line}" for i, line in enumerate("we are all|out of|this long|song and|go home".split("|"), 9)], ("line", "{} *")),
        ([f"{i}. {line}" for i, line in enumerate("one|two|three|four|five|six".split("|"))], ("line", "{}. *")),
        ([f"a{10**30 + i}b" for i in range(-2, 2)], ("number", "a{}b")),
    ],
)
def test_counters_trip(spark, names, want):
    assert want in tripped(spark, [*CLEAN, *names, *names])


def test_decimal_words_are_not_hexadecimal_counters(spark):
    assert {kind for kind, _ in tripped(spark, [f"ap {i}" for i in range(10, 20)])} == {"number"}


def test_equal_rests_are_not_a_text(spark):
    assert ("line", "{} *") not in tripped(spark, [f"{i} lobby" for i in range(9)])


@pytest.mark.parametrize("length", [1, 5, 18, 19, 60, 80])
def test_one_less(spark, length):
    numbers = [10 ** (length - 1), int("9" * length), int("1" + "0" * (length - 1)) + length, 5 * 10 ** (length - 1)]
    rows = spark.createDataFrame([(str(n),) for n in numbers], "n string").select(one_less(F.col("n")).alias("n")).collect()
    assert [r.n for r in rows] == [str(n - 1) for n in numbers]
    assert spark.range(1).select(one_less(F.lit("0"))).first()[0] is None


def test_runs_over_any_power_of_ten(spark):
    names = [f"net{10**60 + i}" for i in range(-3, 3)]
    masks = signals.numbered_masks(seen(spark, names), ["log"])
    found = signals.numbered_names(masks, ["log"], signals.Thresholds(min_run=6)).first()
    assert (found.n_numbers, found.n_run_starts) == (6, 1)


# -- clusters -----------------------------------------------------------------

LIMITS = signals.Thresholds(cluster_deg=1.0, cluster_slot_s=100, cluster_min=4)


def plain_clusters(rows, limits):
    """Cell -> name of its cluster by breadth-first search, per log."""
    cells: dict = {}
    for log, lat, lon, at in rows:
        x, y = int((lon + 180) % 360 // limits.cluster_deg), int((lat + 90) // limits.cluster_deg)
        cells[log, x, y, at // limits.cluster_slot_s] = cells.get((log, x, y, at // limits.cluster_slot_s), 0) + 1
    wide = int(360 / limits.cluster_deg)

    def around(cell):
        log, x, y, t = cell
        return [c for dx in (-1, 0, 1) for dy in (-1, 0, 1) for dt in (-1, 0, 1)
                if (c := (log, (x + dx) % wide, y + dy, t + dt)) in cells]

    dense = {c for c in cells if sum(cells[n] for n in around(c)) >= limits.cluster_min}
    name, done = {}, set()
    for start in sorted(dense, key=lambda c: (c[3], c[2], c[1])):
        todo = [start]
        while todo:
            cell = todo.pop()
            if cell in done:
                continue
            done.add(cell)
            name[cell] = (start[3], start[2], start[1])
            todo += [n for n in around(cell) if n in dense]
    out = {}
    for cell in cells:
        near = [name[n] for n in around(cell) if n in name]
        if near:
            out[cell] = ":".join(map(str, min(near)))
    return out


def sightings(rng, n):
    rows = []
    for log in ("a", "b", None):
        lat, lon, at = rng.uniform(-60, 60), rng.choice([179.5, 0.0, -100.0]), 0
        for _ in range(n):
            lat, at = max(-89.0, min(89.0, lat + rng.uniform(-0.7, 0.7))), at + rng.choice([1, 20, 90, 400])
            lon = (lon + rng.uniform(-0.7, 0.7) + 180) % 360 - 180
            rows += [(log, lat, lon, at)] * rng.choice([1, 1, 3])
    return rows


def frame(spark, rows):
    data = [(log, lat, lon, START + timedelta(seconds=at)) for log, lat, lon, at in rows]
    return spark.createDataFrame(data, "log string, CurrentLatitude double, CurrentLongitude double, ts timestamp")


@pytest.mark.parametrize("seed", range(3))
def test_clusters_equal_plain_search(spark, seed):
    base = int((START - datetime(1970, 1, 1)).total_seconds())
    rows = sightings(random.Random(seed), 120)
    df = frame(spark, [*rows]).unionByName(frame(spark, [("a", None, 1.0, 5), ("b", 1.0, None, 5)]))
    found = clusters.clusters(clusters.occupied(df, "log", LIMITS), "log", LIMITS).collect()
    want = plain_clusters([(log, lat, lon, base + at) for log, lat, lon, at in rows], LIMITS)
    assert len(set(want.values())) > 2
    assert {(r["log"], r["x"], r["y"], r["t"]): r["cluster"] for r in found} == want


def test_no_positions_no_clusters(spark):
    df = frame(spark, [("a", None, None, 1)])
    assert clusters.clusters(clusters.occupied(df, "log", LIMITS), "log", LIMITS).collect() == []


def test_report_tells_places_and_sessions_apart(spark):
    """One log passes a spoofer at one place twice, hours apart; elsewhere nothing trips."""
    rows = []
    for session, hour in enumerate((0, 5)):
        at = START + timedelta(hours=hour)
        rows += [("a", f"s{session}m{i}", f"{i} free wifi", "[WPA2]", 10.0, 20.0, at + timedelta(seconds=10 * i)) for i in range(8)]
        rows += [("a", f"c{session}m{i}", "home", "[WPA2]", 10.5, 20.5, at + timedelta(seconds=1200 + 10 * i)) for i in range(8)]
    df = spark.createDataFrame(
        rows, "log string, MAC string, SSID string, AuthMode string, CurrentLatitude double, CurrentLongitude double, ts timestamp"
    )
    limits = signals.Thresholds(window="1 day", max_speed_mps=1e9)
    found = clusters.cluster_signals(df, phrase_list(spark, [("p", "x")]), "log", limits)
    got = clusters.by_cluster(signals.report(found, "where"), "log").collect()
    assert len(got) == 2 and {r.modules for r in got} == {"sequential"}
    assert len({r.cluster for r in got}) == 2 and all(r.cluster for r in got)
