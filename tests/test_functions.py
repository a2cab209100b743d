from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from airscan.functions import channels, geo, numbers, text


def evaluate(spark, values, dtype, column):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {dtype}")
    return [row.y for row in rows.select("i", column(F.col("x")).alias("y")).orderBy("i").collect()]


def test_to_number(spark):
    texts = ["-70", " 1 ", "1e3", "+.5", "5.", "", "n/a", "nan", "inf", "-Infinity", "1d", "2f", "0x10", "1e999", None]
    want = [-70.0, 1.0, 1000.0, 0.5, 5.0] + [None] * 10
    assert evaluate(spark, texts, "string", numbers.to_number) == want


def test_round_half_even_equals_numpy(spark):
    values = [12.25, 1.015, 0.05, 0.15, 33.333333, 66.666667, -2.5, 99.95]
    for digits in (1, 2):
        got = evaluate(spark, values, "double", lambda x, d=digits: numbers.round_half_even(x, d))
        assert got == [float(v) for v in np.round(values, digits)]


def test_normalize_type_strips_all_whitespace(spark):
    assert evaluate(spark, [" wifi\t", "Ble", "\n gsm", None], "string", text.normalize_type) == ["WIFI", "BLE", "GSM", None]


def test_entropy(spark):
    got = evaluate(spark, ["aaaa", "ab", "abcdefgh", "", None, "äß€😀"], "string", text.char_entropy)
    assert got == [0.0, 1.0, 3.0, 0.0, None, 2.0]


def test_numbered_names(spark):
    names = ["Free Net 12", "x7Qp2Lk9", "plain", "007", None]
    assert evaluate(spark, names, "string", text.is_numbered) == [True, True, False, True, None]
    assert evaluate(spark, names, "string", text.number_prefix) == ["free net", "x7qp2lk", "", "", None]
    assert evaluate(spark, names, "string", text.trailing_digits) == ["12", "9", "", "7", None]
    long = ["net9999999999", "n000", "n" + "1" * 18, "n64" + "0" * 18, "n" + "9" * 40]
    split = evaluate(spark, long, "string", lambda c: F.struct(*text.number_block(text.trailing_digits(c))))
    assert [tuple(x) for x in split] == [
        ("0", 9999999999 // 64, 9999999999 % 64), ("0", 0, 0), ("0", int("1" * 18) // 64, int("1" * 18) % 64),
        ("64", 0, 0), ("9" * 22, (10**18 - 1) // 64, 63),
    ]


def test_surrounding_whitespace_of_any_kind(spark):
    spaces = "\u1680\u2003\u2028\u202f\u205f\u3000\x85\xa0 \t"
    assert evaluate(spark, [spaces + "wi fi" + spaces], "string", text.normalize_type) == ["WI FI"]


def test_haversine(spark):
    row = spark.range(1).select(
        geo.haversine_m(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)).alias("degree"),
        geo.haversine_m(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)).alias("half"),
    ).first()
    assert row.degree == pytest.approx(111_194.93, abs=0.1)
    assert row.half == pytest.approx(math.pi * geo.EARTH_RADIUS_M)


UNII = {1: "UNII-1 (36-48, no DFS)", 2: "UNII-2A/2C (52-96, DFS)", 3: "UNII-3 (100-148, DFS)", 4: "UNII-4 (149-177, no DFS)"}
CHANNEL_GOLDEN = [
    (1.0, "2.4GHz", "2.4GHz_ch1", None),
    (14.0, "2.4GHz", "2.4GHz_ch14", None),
    (6.7, "2.4GHz", "2.4GHz_ch6", None),
    (36.0, "5GHz", "5GHz_UNII1_36-48", UNII[1]),
    (48.0, "5GHz", "5GHz_UNII1_36-48", UNII[1]),
    (52.0, "5GHz", "5GHz_UNII2_52-96", UNII[2]),
    (96.0, "5GHz", "5GHz_UNII2_52-96", UNII[2]),
    (100.0, "5GHz", "5GHz_UNII3_100-148", UNII[3]),
    (148.0, "5GHz", "5GHz_UNII3_100-148", UNII[3]),
    (149.0, "5GHz", "5GHz_UNII4_149-177", UNII[4]),
    (177.0, "5GHz", "5GHz_UNII4_149-177", UNII[4]),
    (38.0, "5GHz", "5GHz_ch38", None),
    (150.0, "5GHz", "5GHz_ch150", None),
    (-1.0, "unknown", "5GHz_ch-1", None),
    (0.0, "unknown", "5GHz_ch0", None),
    (0.5, "unknown", "5GHz_ch0", None),
    (35.0, "unknown", "5GHz_ch35", None),
    (178.0, "unknown", "5GHz_ch178", None),
    (None, "unknown", "unknown", None),
]


def test_channel_plan(spark):
    values = [row[0] for row in CHANNEL_GOLDEN]
    for position, function in ((1, channels.channel_band), (2, channels.channel_group), (3, channels.channel_unii)):
        assert evaluate(spark, values, "double", function) == [row[position] for row in CHANNEL_GOLDEN]


def test_strict_group_follows_band(spark):
    got = evaluate(spark, [-1.0, 20.0, 200.0, 38.0], "double", lambda c: channels.channel_group(c, strict=True))
    assert got == ["unknown", "unknown", "unknown", "5GHz_ch38"]


def test_frequencies(spark):
    assert evaluate(spark, [1.0, 6.0, 13.0, 14.0, 36.0, None], "double", channels.channel_mhz) == [2412, 2437, 2472, 2484, None, None]


def test_short_unii(spark):
    rows = spark.createDataFrame([(UNII[2], "5GHz"), (UNII[2], "2.4GHz"), (None, "5GHz")], "u string, b string")
    assert [r[0] for r in rows.select(channels.short_unii(F.col("u"), F.col("b"))).collect()] == ["UNII-2A/2C", "", ""]
