from __future__ import annotations

import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from airscan.operators import signals, trials
from airscan.operators.phrases import match_phrases, phrase_list
from airscan.plans.detector import scan_logs

START = dt.datetime(2024, 5, 1, tzinfo=dt.timezone.utc)
SCHEMA = "_log_id string, ts timestamp, MAC string, SSID string, AuthMode string, CurrentLatitude double, CurrentLongitude double"
JOKES = [("joke", "Pretty Fly for a  WiFi"), ("joke", "abraham linksys"), ("lyrics", "never gonna give you up"), ("other", "Abraham Linksys")]
SECURE = "[WPA2-PSK-CCMP][ESS]"


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def sighting(seconds, ssid, auth=SECURE, mac=None, log="log", lat=52.0, lon=4.0):
    return (log, at(seconds), mac or f"mac-{ssid}", ssid, auth, lat, lon)


def clean_log(log="log"):
    """A slow drive past a new encrypted network every few seconds, some with unusual names."""
    rng = random.Random(1)
    names = ["home", "SKY4F2K", "x7Qp2Lk9Zw", "FRITZ!Box 7590", "NETGEAR81", "TP-Link_A3F2", "cafe-guest", "", None]
    return [
        sighting(i * 7, rng.choice(names), mac=f"m{i}", log=log, lat=52 + i * 1e-4, lon=4 + i * 1e-4) for i in range(200)
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def tripped(spark, rows, limits=signals.DEFAULTS):
    found = signals.all_signals(frame(spark, rows), phrase_list(spark, JOKES), "_log_id", limits).filter("tripped")
    return {row.module for row in found.collect()}


def test_clean_log_trips_nothing(spark):
    assert tripped(spark, clean_log()) == set()


def random_names(count=40):
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return ["".join(rng.sample(letters, 12)) for _ in range(count)]


def test_random_names_on_open_networks(spark):
    assert tripped(spark, clean_log() + [sighting(2000 + i * 5, n, "[OPEN][ESS]") for i, n in enumerate(random_names())]) == {"entropy"}


def test_random_names_on_encrypted_networks_never_trip(spark):
    assert tripped(spark, [sighting(i * 5, n) for i, n in enumerate(random_names())]) == set()


def test_joke_list(spark):
    rows = [sighting(i * 60, name, mac=f"j{i}") for i, name in enumerate(["Pretty  fly for a wifi ", "ABRAHAM LINKSYS"])]
    assert tripped(spark, clean_log() + rows) == {"dictionary"}
    hits = signals.dictionary_hits(frame(spark, rows), phrase_list(spark, JOKES)).collect()
    assert {(r.phrase, r.pack) for r in hits} == {("pretty fly for a wifi", "joke"), ("abraham linksys", "joke|other")}


def test_phrase_filters(spark):
    rows = frame(spark, [sighting(0, "abraham linksys"), sighting(1, "x"), sighting(2, None)])
    phrases = phrase_list(spark, JOKES)
    assert {how: match_phrases(rows, phrases, how).count() for how in ("left", "inner", "left_semi", "left_anti")} == {
        "left": 3, "inner": 1, "left_semi": 1, "left_anti": 2}


def test_numbered_names(spark):
    assert tripped(spark, clean_log() + [sighting(i * 3, f"Free WiFi {i}", mac=f"s{i}") for i in (1, 2, 3, 4)]) == {"sequential"}
    assert tripped(spark, [sighting(i, f"net {i * 10}") for i in range(5)]) == {"sequential"}
    assert tripped(spark, [sighting(i * 9, f"net {n}") for i, n in enumerate((1, 2, 3, 7))]) == set()


def test_burst_against_own_distribution(spark):
    burst = [sighting(896, "b", mac=f"burst{i}", lat=52 + 128e-4, lon=4 + 128e-4) for i in range(40)]
    assert tripped(spark, clean_log() + burst) == {"burst"}
    steady = [sighting(s, "n", mac=f"{s}-{i}") for s in range(100) for i in range(20)]
    assert tripped(spark, steady) == set()


def test_position_jump(spark):
    assert tripped(spark, clean_log() + [sighting(703, "far", mac="m0", lat=-33.0, lon=151.0)]) == {"gps_churn"}
    assert tripped(spark, [sighting(5, "a", lat=1.0), sighting(5, "b", lat=1.1)]) == {"gps_churn"}


def test_run_starts_against_brute_force(spark):
    rng = random.Random(11)
    for length in (1, 2, 4, 64, 65, 80, 130, 200):
        numbers = {p: {rng.randrange(400) for _ in range(250)} | {62, 63, 64, 65, 127, 128} for p in "abc"}
        numbers["d"] = set(range(1000, 1400))
        numbers["e"] = {9999999999 + k for k in range(100)}
        numbers["f"] = {10**18 - 40 + k for k in range(85)} | {10**19 - 2 + k for k in range(5)} | {10**30 + k for k in range(70)}
        numbers["g"] = {int("9" * 36) - 3 + k for k in range(140)}
        rows = frame(spark, [sighting(0, f"{p} {n}") for p, ns in numbers.items() for n in ns for _ in range(2)])
        limits = signals.Thresholds(min_run=length)
        got = {r.prefix: (r.n_numbers, r.n_run_starts) for r in signals.sequential(rows, "_log_id", limits).collect()}
        want = {p: (len(ns), sum(all(n + k in ns for k in range(length)) for n in ns)) for p, ns in numbers.items()}
        assert got == want


def test_baseline_counts_idle_ticks(spark):
    rng = random.Random(2)
    counts = {log: {t: rng.randint(1, 9) for t in rng.sample(range(60), busy)} for log, busy in (("x", 50), ("y", 10), ("z", 60))}
    rows = [(log, t, n, max(ticks)) for log, ticks in counts.items() for t, n in ticks.items()]
    per_tick = spark.createDataFrame(rows, "_log_id string, tick long, n_new long, _last_tick long")
    got = {r._log_id: (r.median, r.mad) for r in
           signals.burst_baseline(signals.tick_histogram(per_tick, "_log_id"), "_log_id").collect()}
    for log, ticks in counts.items():
        series = [ticks.get(t, 0) for t in range(min(ticks), max(ticks) + 1)]
        middle = statistics.median(series)
        assert got[log] == (middle, statistics.median(abs(v - middle) for v in series))


def brute_steps(fixes):
    steps = []
    for a, b in zip(fixes, fixes[1:]):
        if a[0] != b[0]:
            continue
        dlat, dlon = math.radians(b[2] - a[2]), math.radians(b[3] - a[3])
        chord = math.sin(dlat / 2) ** 2 + math.cos(math.radians(a[2])) * math.cos(math.radians(b[2])) * math.sin(dlon / 2) ** 2
        distance = 2 * 6_371_000 * math.asin(math.sqrt(min(chord, 1)))
        steps.append((b[0], b[1].replace(tzinfo=None), round(distance, 2), (b[1] - a[1]).total_seconds()))
    return steps


@pytest.mark.parametrize("chunk_s", [1, 30, 100_000])
def test_churn_over_chunks_equals_plain_order(spark, chunk_s):
    rng = random.Random(4)
    fixes = set()
    for i in range(900):
        log = "hot" if i % 3 else f"log{i % 7}"
        fixes.add((log, at(rng.choice((rng.randrange(200), rng.randrange(90_000)))), 50 + rng.randrange(5) / 10, 4.0))
    rows = frame(spark, [(log, ts, "m", "s", SECURE, lat, lon) for log, ts, lat, lon in fixes for _ in range(2)])
    got = signals.gps_churn(rows, "_log_id", signals.Thresholds(churn_chunk_s=chunk_s)).collect()
    found = sorted((r._log_id, r.ts, round(r.distance_m, 2), r.elapsed_s) for r in got)
    assert found == sorted(brute_steps(sorted(fixes)))
    assert all(r.tripped == (r.elapsed_s == 0 or r.distance_m / r.elapsed_s > 90) for r in got)


def test_report_lists_reasons(spark):
    rows = [sighting(i, f"Spam {i}", mac=f"s{i}") for i in range(6)] + [sighting(10, "abraham linksys")]
    found = signals.all_signals(frame(spark, rows), phrase_list(spark, JOKES), "_log_id")
    row = signals.report(found, "_log_id").first()
    assert row.modules == "dictionary,sequential" and row.n_signals == 2
    assert [s.reason for s in row.signals] == ["1 names from a phrase list, e.g. abraham linksys", "6 numbers behind one prefix"]


def test_scan_logs_from_files(spark, tmp_path):
    header = "meta\nMAC,SSID,AuthMode,FirstSeen,RSSI,CurrentLatitude,CurrentLongitude,Type\n"
    (tmp_path / "clean.csv").write_text(header + "a,home,[WPA2],2024-05-01 10:00:00,-1,52,4,WIFI\n")
    lines = [f"b{i},Spam {i},[OPEN],2024-05-01 10:00:0{i},-1,52,4,WIFI\n" for i in range(6)]
    (tmp_path / "spam.csv").write_text(header + "".join(lines) + "c,n,[OPEN],not a time,-1,52,4,WIFI\n")
    rows = scan_logs(spark, str(tmp_path), phrase_list(spark, JOKES)).report.collect()
    assert [(r._log_id.rsplit("/", 1)[1], r.modules) for r in rows] == [("spam.csv", "sequential")]


# -- trials -------------------------------------------------------------------


def trial_frame(spark, spans):
    rows = [(i, at(a), at(b)) for i, (a, b) in enumerate(spans, 1)]
    return spark.createDataFrame(rows, "trial_id int, stop_ts timestamp, end_ts timestamp")


def test_recorded_style_trials_are_clean(spark):
    spans = [(i * 100, i * 100 + 30) for i in range(8)]
    log = clean_log() + [sighting(i * 100, "abraham linksys") for i in range(8)]
    outcomes = trials.trial_outcomes(frame(spark, log), trial_frame(spark, spans), phrase_list(spark, JOKES))
    assert {r.outcome for r in outcomes.collect()} == {"clean"}
    assert tuple(trials.trial_summary(outcomes).first()) == (8, 8)


def test_contaminated_trials(spark):
    spans = [(0, 30), (10, 200), (300, 330), (400, 400)]
    log = [sighting(30, "abraham linksys"), sighting(150, "qwertyuiop", "[OPEN]"), sighting(301, "qwertyuiop"), sighting(400, "abraham linksys")]
    outcomes = trials.trial_outcomes(frame(spark, log), trial_frame(spark, spans), phrase_list(spark, JOKES))
    got = {r.trial_id: (r.phrase_hits, r.entropy_hits, r.outcome) for r in outcomes.collect()}
    assert got == {1: (1, 0, "contaminated"), 2: (1, 1, "contaminated"), 3: (0, 0, "clean"), 4: (0, 0, "clean")}


@pytest.mark.parametrize("tolerance", [1, 10, 60])
def test_corroboration_against_brute_force(spark, tolerance):
    rng = random.Random(tolerance)
    macs = ["hot"] * 5 + [f"m{i}" for i in range(8)] + [None]

    def device(count):
        return [(f"r{i}", START + dt.timedelta(milliseconds=rng.randrange(4_000_000)), rng.choice(macs)) for i in range(count)]

    schema = "id string, ts timestamp, MAC string"
    a, b = device(150), device(300)
    b.append(("edge", a[0][1] + dt.timedelta(seconds=tolerance), a[0][2] or "hot"))
    test_log, truth = spark.createDataFrame(b, schema), spark.createDataFrame(a, schema)
    limit = dt.timedelta(seconds=tolerance)
    want = {i for i, ts, mac in b if mac and any(m == mac and abs(t - ts) <= limit for _, t, m in a)}
    assert {r.id for r in trials.corroborated(test_log, truth, tolerance).collect()} == want
    assert {r.id for r in trials.uncorroborated(test_log, truth, tolerance).collect()} == {r[0] for r in b} - want


def test_no_pairs_are_formed(spark):
    rows = spark.createDataFrame([("r", START, "m")], "id string, ts timestamp, MAC string")
    plan = trials.heard_by_truth(rows, rows, 5)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    with pytest.raises(ValueError):
        trials.heard_by_truth(rows, rows, 0)


def test_entropy_columns(spark):
    rows = frame(spark, [sighting(0, "abcdefgh", "[OPEN]"), sighting(0, "abcdefgh"), sighting(0, "short", "[OPEN]"), sighting(0, None, None)])
    got = signals.entropy_auth(rows).select("entropy", "entropy_ratio", "tripped").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(3.0, 1.0, True), (None, None, False), (None, None, False), (None, None, False)], key=str)
    assert signals.entropy_auth(rows).filter(F.col("tripped")).count() == 1


def test_many_long_trials_are_joined_without_broadcast(spark):
    from airscan.operators.trials import sightings_in_trials

    trials = spark.range(2000).selectExpr(
        "id AS trial_id", "TIMESTAMP '2024-01-01' + make_interval(0, 0, 0, id) AS stop_ts",
        "TIMESTAMP '2024-01-01' + make_interval(0, 1, 0, id) AS end_ts")
    seen = spark.range(500).selectExpr("id", "TIMESTAMP '2024-03-01' + make_interval(0, 0, 0, id) AS ts")
    joined = sightings_in_trials(seen, trials)
    assert "BroadcastExchange" not in joined._jdf.queryExecution().executedPlan().toString()
    want = seen.crossJoin(trials).filter("ts > stop_ts AND ts <= end_ts")
    assert joined.count() == want.count() > 0


def test_dense_hours_are_cut_finer(spark):
    rng = random.Random(8)
    start = dt.datetime(2024, 5, 1)
    fixes = [(rng.choice(["x", "y", None]), start + dt.timedelta(microseconds=rng.randrange(2 * 3600 * 10**6)), rng.uniform(-1, 1), 4.0)
             for _ in range(3000)]
    frame_ = spark.createDataFrame(fixes, "_log_id string, ts timestamp, lat double, lon double")
    coarse = signals.consecutive_fixes(frame_, "_log_id").select("_log_id", "ts", "lat", "prev.ts", "prev.lat")
    fine = signals.consecutive_fixes(frame_, "_log_id", most=20).select("_log_id", "ts", "lat", "prev.ts", "prev.lat")
    chunks = signals.chunked_fixes(frame_, "_log_id", 3600, 20).groupBy("_log_id", "_chunk").count()
    assert chunks.agg({"count": "max"}).first()[0] < 80
    assert sorted(map(str, fine.collect())) == sorted(map(str, coarse.collect()))


def test_phrases_inside_names_equal_a_plain_search(spark):
    from airscan.operators.phrases import contained_phrases

    rng = random.Random(3)
    vocabulary = ["free", "wifi", "fly", "a", "Net", "5g", "é"]
    names = [" ".join(rng.choices(vocabulary, k=rng.randrange(6))) for _ in range(300)] + [None, "", "  ", "free  WIFI", "a\tfly"]
    listed = [("p", " ".join(rng.choices([*vocabulary[:5], "{}"], k=rng.randrange(1, 4)))) for _ in range(60)] + [("q", "Free wifi")]

    def held(name, phrase):
        words, terms = (name or "").lower().split(), phrase.lower().split()
        return any(all(t in ("{}", w) for t, w in zip(terms, words[i:], strict=False)) for i in range(len(words) - len(terms) + 1))

    kept = {p.lower() for _, p in listed if set(p.split()) != {"{}"}}
    want = {(i, p) for i, name in enumerate(names) for p in kept if held(name, p)}
    rows = spark.createDataFrame(list(enumerate(names)), "id int, SSID string")
    got = contained_phrases(rows, phrase_list(spark, listed)).collect()
    assert len(got) == len(want) and {(r.id, r.phrase) for r in got} == want
    assert {r.pack for r in got if r.phrase == "free wifi"} <= {"q", "p|q"}
