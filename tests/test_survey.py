from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from airscan.operators import compare, normalize, summaries
from airscan.operators.dedup import strongest, strongest_wifi
from airscan.plans.compare_scans import compare_paths, compare_scans
from airscan.plans.survey import unique_devices

COLUMNS = "MAC string, Type string, RSSI string, Channel string, CurrentLatitude string, CurrentLongitude string, FirstSeen string"


def rows_of(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def sample(count=2000, seed=3):
    """A third of all rows share one device, some lack MAC or RSSI."""
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        mac = "hot" if i % 3 == 0 else rng.choice([None, *[f"m{n}" for n in range(200)]])
        rssi = rng.choice(["", "n/a", "nan", *[str(-n) for n in range(30, 99)]])
        rows.append((mac, rng.choice(["WIFI", " wifi", "BLE\t", "XYZ", None]), rssi, str(rng.randint(-1, 170)),
                     str(rng.uniform(-60, 70)), rng.choice(["", str(rng.uniform(-150, 150))]), f"t{i:05d}"))
    return rows


def test_type_list_and_missing_types(spark):
    rows = rows_of(spark, [(str(i), t, "-1", "1", "", "", "") for i, t in enumerate(["wifi", "lte ", "XYZ", None, "none"])])
    assert {r.Type for r in normalize.keep_types(rows).collect()} == {"WIFI", "LTE"}
    assert {r.Type for r in normalize.keep_types(rows, " none , xyz").collect()} == {"NONE", "XYZ"}
    assert normalize.keep_types(rows, None).count() == 5


def test_strongest_against_brute_force(spark):
    rows = sample()
    want = {}
    for row in rows:
        radio = (row[1] or "").strip().upper()
        if radio not in ("WIFI", "BLE"):
            continue
        rssi = float(row[2]) if row[2].startswith("-") else None
        rank = (rssi is None, -(rssi or 0), row[6])
        key = (row[0], radio)
        want[key] = min(want.get(key, (rank, row[6])), (rank, row[6]))
    frame = rows_of(spark, rows)
    for partitions in (1, 7):
        got = unique_devices(frame.repartition(partitions)).collect()
        assert len(got) == len(want)
        assert {(r.MAC, r.Type): r.FirstSeen for r in got} == {key: value[1] for key, value in want.items()}


def test_hot_device_is_cut_before_the_shuffle(spark):
    text = unique_devices(rows_of(spark, sample(30)))._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Exchange") < text.rindex("WindowGroupLimit")


def test_wifi_dedup_without_signal_column(spark):
    rows = spark.createDataFrame([("a", "2.csv", "x"), ("a", "1.csv", "y"), ("b", "1.csv", "z")], "MAC string, _file string, SSID string")
    assert sorted(tuple(r) for r in strongest_wifi(rows).collect()) == [("a", "1.csv", "y"), ("b", "1.csv", "z")]


def test_absent_numeric_columns_become_null(spark):
    rows = spark.createDataFrame([("a", "WIFI")], "MAC string, Type string")
    row = strongest(normalize.coerce_numbers(rows)).first()
    assert row.RSSI is None and row.CurrentLatitude is None
    assert normalize.with_channel(rows).first().channel_int is None


def test_channel_and_band_summaries(spark):
    rows = spark.createDataFrame(
        [("usa", "texas", "WIFI", c) for c in ("1", "1", "36", "-1", "", "abc")]
        + [("usa", "texas", "BLE", "1"), ("france", None, "WIFI", "6"), ("other", None, "BLE", "1")],
        "country string, state string, Type string, Channel string",
    )
    cube = summaries.channel_cube(rows)
    bands = {(r.level, r.region, r.band): (r["count"], r.wifi_total) for r in summaries.band_summary(cube).collect()}
    assert bands == {
        **{(level, name, "2.4GHz"): (2, 6) for level, name in (("country", "usa"), ("us_state", "texas"))},
        **{(level, name, "5GHz"): (1, 6) for level, name in (("country", "usa"), ("us_state", "texas"))},
        **{(level, name, "unknown"): (3, 6) for level, name in (("country", "usa"), ("us_state", "texas"))},
        ("country", "france", "2.4GHz"): (1, 1),
    }
    channels = [(r.channel_int, r.band, r.channel_group, r["count"]) for r in
                summaries.channel_summary(cube).filter("region = 'texas'").orderBy("channel_int").collect()]
    assert channels == [(-1.0, "unknown", "5GHz_ch-1", 1), (1.0, "2.4GHz", "2.4GHz_ch1", 2), (36.0, "5GHz", "5GHz_UNII1_36-48", 1)]


def test_observed_rows(spark):
    counted, observation = summaries.observe_rows(rows_of(spark, sample(50)), "read")
    counted.write.format("noop").mode("overwrite").save()
    assert observation.get["rows"] == 50


def scan(spark, channels):
    return spark.createDataFrame([(f"m{i}", "WIFI", "-50", c) for i, c in enumerate(channels)], "MAC string, Type string, RSSI string, Channel string")


def test_comparison_golden(spark):
    a = scan(spark, ["1"] * 3 + ["36"] * 3 + ["40"] + ["-1"])
    b = scan(spark, ["36"] * 2 + ["149"] * 2 + ["38"])
    result = compare_scans(a, b, "X", "Y")
    bands = {r.band: (r.X_count, r.X_pct, r.Y_count, r.Y_pct, r.pct_delta, r.flag) for r in result.bands.collect()}
    assert bands == {
        "2.4GHz": (3, 37.5, 0, 0.0, -37.5, "A_higher"),
        "5GHz": (4, 50.0, 5, 100.0, 50.0, "B_higher"),
        "unknown": (1, 12.5, 0, 0.0, -12.5, "A_higher"),
    }
    channels = {r.channel_int: (r.unii[:6], r.X_count, r.X_pct, r.Y_count, r.Y_pct, r.pct_delta) for r in result.channels.collect()}
    assert channels == {
        36.0: ("UNII-1", 3, 75.0, 2, 50.0, -25.0),
        40.0: ("UNII-1", 1, 25.0, 0, 0.0, -25.0),
        149.0: ("UNII-4", 0, 0.0, 2, 50.0, 50.0),
    }
    full = compare_scans(a, b, include_ungrouped=True).channels
    assert {r.channel_int for r in full.collect()} == {1.0, 36.0, 38.0, 40.0, 149.0}
    assert [r.channel_int for r in compare.most_divergent(result.channels, 2).collect()] == [149.0, 36.0]


def test_flag_at_exactly_one_point(spark):
    rows = spark.createDataFrame([(1.0,), (-1.0,), (0.99,), (0.0,)], "d double")
    assert [r[0] for r in rows.select(compare.divergence(F.col("d"))).collect()] == ["B_higher", "A_higher", None, None]


def test_outer_join_equals_single_pass(spark):
    sides = compare.prepare(compare.tag_sides(scan(spark, ["1", "36", "36", "100"]), scan(spark, ["36", "149"])), ["side"])
    table = compare.channel_table(sides, ["side"])
    keys = ["channel_int", "band"]
    halves = [table.filter(F.col("side") == side).drop("side") for side in "AB"]
    joined = compare.merge_tables(*halves, keys, 2)
    single = compare.compare_channels(sides)
    assert sorted(map(tuple, joined.select(*single.columns).collect())) == sorted(map(tuple, single.collect()))


def test_unknown_only_side_and_single_scan_tables(spark):
    sides = compare.tag_sides(scan(spark, ["", "-1"]), scan(spark, ["36"]).drop("Channel"))
    prepared = compare.prepare(sides, ["side"])
    assert compare.compare_channels(prepared).count() == 0
    assert [tuple(r) for r in compare.band_table(prepared.filter("side = 'A'")).collect()] == [("unknown", 2, 100.0)]


def test_shares_within_any_grouping(spark):
    counts = spark.createDataFrame([("x", 1), ("x", 3), ("y", 5)], "log string, count long")
    assert sorted(r.pct for r in compare.with_share(counts, ["log"], 1).collect()) == [25.0, 75.0, 100.0]
    assert sorted(r.pct for r in compare.with_share(counts, [], 1).collect()) == [11.1, 33.3, 55.6]


def test_display(spark):
    result = compare_scans(scan(spark, ["36"] * 1500), scan(spark, ["36", "149"]))
    row = compare.display_channels(result.channels).collect()[0]
    assert tuple(row) == (36, "5GHz", "UNII-1", "1,500", "100.00%", "1", "50.00%", "-50.00", "▼")
    assert compare.display_bands(result.bands).first().pct_delta == "+0.0"


def test_compare_paths_and_report(spark, tmp_path):
    for side, channel in (("a", "36"), ("b", "149")):
        (tmp_path / f"{side}.csv").write_text(f"meta\nMAC,Type,RSSI,Channel\nm1,WIFI,-1,{channel}\nm1,WIFI,-9,1\n")
    compare_paths(spark, str(tmp_path / "a.csv"), str(tmp_path / "b.csv"), out=str(tmp_path / "report"))
    report = spark.read.option("header", True).csv(str(tmp_path / "report" / "channels"))
    assert [(r.channel_int, r.Scan_A_count, r.Scan_B_count, r.flag) for r in report.collect()] == [
        ("36.0", "1", "0", "A_higher"), ("149.0", "0", "1", "B_higher")]


def test_comparison_reads_each_scan_once(spark, tmp_path):
    scan(spark, ["36", "40"]).write.parquet(str(tmp_path / "a"))
    scan(spark, ["36", "149"]).write.parquet(str(tmp_path / "b"))
    result = compare_scans(spark.read.parquet(str(tmp_path / "a")), spark.read.parquet(str(tmp_path / "b")))
    result.channels.collect()
    final = result.channels._jdf.queryExecution().executedPlan().toString()
    assert result.channels.count() == 3
    assert "CartesianProduct" not in final and "BroadcastNestedLoopJoin" not in final


@pytest.mark.parametrize("types", [None, "BLE"])
def test_funnel(spark, types):
    raw = rows_of(spark, sample(300))
    unique = unique_devices(raw, types)
    stages = {r.stage: r.n for r in summaries.funnel(raw, unique, types).collect()}
    assert stages["rows_read"] == 300
    assert stages["after_type_filter"] == normalize.keep_types(raw, types).count()
    assert stages["after_dedup"] == stages["geolocated"] + stages["no_gps"] == unique.count()
