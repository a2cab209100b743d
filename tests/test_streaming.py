from __future__ import annotations


import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from airscan.operators import normalize, signals
from airscan.operators.phrases import phrase_list
from airscan.sources.testview import EVENT_SCHEMA, as_observations
from airscan.streaming import observations as streams
from airscan.streaming.sinks import latest_per_key, run_once

EVENTS = "/root/testdata/sf0.001/events.parquet"
LOG = "log_no"
DAILY = signals.Thresholds(window="1 day", burst_tick_s=3600, burst_min_new=2, burst_min_score=2.0)


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    """The events cut into five files in time order, each read as its own micro-batch."""
    root = tmp_path_factory.mktemp("landing")
    events = spark.read.parquet(EVENTS).orderBy("ts")
    for i in range(5):
        part = events.filter((F.col("event_id") >= i * 200) & (F.col("event_id") < (i + 1) * 200))
        part.coalesce(1).write.parquet(str(root / f"part{i}"))
    return str(root)


def stream(spark, landing):
    reader = spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True)
    return normalize.with_seen(as_observations(reader.parquet(landing)))


def batch(spark):
    return normalize.with_seen(as_observations(spark.read.parquet(EVENTS)))


def rows(frame, *names):
    return sorted(map(str, frame.select(*names).collect()))


def run(frame, tmp_path, mode="update"):
    run_once(frame, str(tmp_path / "out"), str(tmp_path / "checkpoint"), mode)
    return str(tmp_path / "out")


def test_events_are_in_time_order(spark):
    seen = [r.ts for r in spark.read.parquet(EVENTS).orderBy("event_id").collect()]
    assert seen == sorted(seen)


def test_strongest_over_several_batches(spark, landing, tmp_path):
    from airscan.plans.survey import unique_devices

    typed = normalize.coerce_numbers(normalize.keep_types(stream(spark, landing)), ["RSSI"])
    typed = typed.select("MAC", "Type", "RSSI", "event_id")
    want = unique_devices(batch(spark), ties=["event_id"])
    names = ("MAC", "Type", "RSSI", "event_id")
    path = run(streams.strongest_of(typed, ties=["event_id"]), tmp_path / "state")
    assert spark.read.parquet(path).select("batch").distinct().count() == 5
    assert rows(latest_per_key(spark, path, ["MAC", "Type"]), *names) == rows(want, *names)
    merged = finished(streams.strongest_batches(str(tmp_path / "merged"), ties=["event_id"]), typed, tmp_path)
    assert rows(merged.result(spark), *names) == rows(want, *names)


COUNTS = ("window_start", "country", "band", "count")


def whole_counts(spark, tmp_path):
    once = streams.count_batches(str(tmp_path / "once"))
    once(batch(spark), 0)
    return once.result(spark)


def finished(sink, frame, tmp_path):
    sink.start(frame, str(tmp_path / "checkpoint"), once=True).awaitTermination()
    return sink


@pytest.mark.parametrize("compact_every", [0, 1, 2, 64])
def test_counts_over_several_batches(spark, landing, tmp_path, compact_every):
    counts = streams.count_batches(str(tmp_path / "counts"), "1 day", "1 day")
    counts.compact_every = compact_every
    finished(counts, stream(spark, landing), tmp_path)
    assert spark.read.parquet(str(tmp_path / "counts/partials")).select("batch").distinct().count() == 5
    assert rows(counts.result(spark), *COUNTS) == rows(whole_counts(spark, tmp_path), *COUNTS)
    assert counts.late(spark).count() == 0


@pytest.mark.parametrize("compact_every", [0, 2])
def test_late_rows_are_counted_and_kept(spark, tmp_path, compact_every):
    events = spark.read.parquet(EVENTS)
    for name, part in (("a", "event_id >= 700"), ("b", "event_id BETWEEN 500 AND 699"), ("c", "event_id < 500")):
        events.filter(part).coalesce(1).write.parquet(str(tmp_path / "in" / name))
    counts = streams.count_batches(str(tmp_path / "counts"), "1 day", "1 hour")
    counts.compact_every = compact_every
    finished(counts, stream(spark, str(tmp_path / "in")), tmp_path)
    assert rows(counts.result(spark), *COUNTS) == rows(whole_counts(spark, tmp_path), *COUNTS)
    late = counts.late(spark).agg(F.sum("late_rows")).first()[0]
    placed = counts.result(spark).agg(F.sum("count")).first()[0]
    assert placed / 2 < late < placed
    closed = counts.closed(spark)
    assert 0 < closed.count() < counts.result(spark).count()


def test_numbered_names_over_several_batches(spark, landing, tmp_path):
    masks = finished(streams.mask_batches(str(tmp_path / "masks"), LOG, DAILY), stream(spark, landing), tmp_path)
    names = (LOG, "window_start", "prefix", "n_numbers", "n_run_starts", "tripped")
    got = signals.numbered_names(masks.result(spark), [LOG, "window_start"], DAILY)
    assert rows(got, *names) == rows(signals.sequential(batch(spark), LOG, DAILY), *names)


def test_report_of_all_modules_from_one_stream(spark, tmp_path):
    phrases = phrase_list(spark, [("joke", "pretty fly for a wifi")])
    spark.read.parquet(EVENTS).repartition(4, "event_id").write.parquet(str(tmp_path / "in"))
    sink = finished(streams.SignalBatches(str(tmp_path / "out"), phrases, LOG, "bigint", DAILY), stream(spark, str(tmp_path / "in")), tmp_path)
    names = (LOG, "window_start", "module", "score", "tripped", "reason")
    assert rows(sink.signals(spark), *names) == rows(signals.all_signals(batch(spark), phrases, LOG, DAILY), *names)
    assert sink.names.late(spark).count() > 0 and sink.churn.late(spark).count() > 0


def test_stateless_signals(spark, landing, tmp_path):
    phrases = phrase_list(spark, [("joke", "pretty fly for a wifi")])
    path = run(streams.dictionary_stream(stream(spark, landing), phrases).select("event_id", "pack"), tmp_path / "d", "append")
    assert rows(spark.read.parquet(path), "event_id", "pack") == rows(
        signals.dictionary_hits(batch(spark), phrases), "event_id", "pack")
    path = run(streams.entropy_stream(stream(spark, landing)).select("event_id"), tmp_path / "e", "append")
    assert rows(spark.read.parquet(path), "event_id") == rows(signals.entropy_auth(batch(spark)).filter("tripped"), "event_id")


def test_bursts_from_streamed_first_sightings(spark, landing, tmp_path):
    first = finished(streams.first_sighting_batches(str(tmp_path / "first"), LOG), stream(spark, landing), tmp_path)
    got = signals.burst_scores(signals.new_per_tick(first.result(spark), LOG, DAILY.burst_tick_s), LOG, DAILY)
    names = (LOG, "tick", "n_new", "score", "tripped")
    assert rows(got, *names) == rows(signals.burst_density(batch(spark), LOG, DAILY), *names)


STEPS = (LOG, "ts", "lat", "lon", "distance_m", "elapsed_s", "tripped")


def test_churn_carries_the_last_fix(spark, landing, tmp_path):
    churn = finished(streams.ChurnBatches(str(tmp_path), LOG, "bigint"), stream(spark, landing), tmp_path)
    assert churn.late(spark).count() == 0
    assert rows(churn.steps(spark), *STEPS) == rows(signals.gps_churn(batch(spark), LOG), *STEPS)


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1), (1, 2, 0)])
def test_churn_in_any_order_of_arrival(spark, tmp_path, order):
    """Parts that interleave in time; null logs and moves at one instant included."""
    whole = batch(spark).withColumns({LOG: F.expr("nullif(log_no, 2)"), "ts": F.date_trunc("hour", "ts")})
    churn = streams.ChurnBatches(str(tmp_path), LOG, "bigint")
    for batch_id, part in enumerate(order):
        for _ in range(2):  # a repeated batch changes nothing
            churn(whole.filter((F.col("event_id") * 7 + F.col("event_id") % 5) % 3 == part), batch_id)
    assert churn.late(spark).count() > 0
    assert rows(churn.steps(spark), *STEPS) == rows(signals.gps_churn(whole, LOG), *STEPS)


def test_a_move_at_one_instant_over_two_batches(spark, tmp_path):
    fixes = [(1, "2024-01-01 00:00:00", 1.0, 1.0), (1, "2024-01-01 00:00:00", 2.0, 2.0), (1, "2024-01-01 01:00:00", 2.0, 2.0)]
    frame = spark.createDataFrame(fixes, "log_no bigint, ts string, CurrentLatitude double, CurrentLongitude double")
    frame = frame.withColumn("ts", F.col("ts").cast("timestamp"))
    churn = streams.ChurnBatches(str(tmp_path), LOG, "bigint")
    churn(frame.filter("CurrentLatitude = 1"), 0)
    churn(frame.filter("CurrentLatitude = 2"), 1)
    assert sorted(r.tripped for r in churn.steps(spark).collect()) == [False, True]


def test_burst_counts_are_taken_back_and_survive_a_restart(spark, tmp_path):
    """Later runs on the same checkpoint bring earlier sightings of known devices; the counts are those of a batch run."""
    from airscan.streaming.keyed import BurstBatches

    events = spark.read.parquet(EVENTS)
    landing = str(tmp_path / "landing")
    sink = BurstBatches(str(tmp_path / "ticks"), LOG, "bigint", DAILY)
    null_log = F.when(F.col(LOG) != 3, F.col(LOG)).alias(LOG)
    seen = events.filter("event_id < 0")
    for wanted in ("event_id >= 700", "event_id between 300 and 699", "event_id < 300"):
        new = events.filter(wanted)
        new.repartition(2).write.mode("append").parquet(landing)
        seen = seen.unionByName(new)
        rows = normalize.with_seen(as_observations(spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(landing)))
        rows = rows.withColumn("ts", F.when(F.col("event_id") % 50 != 0, F.col("ts"))).select(null_log, "MAC", "ts")
        sink.start(rows, str(tmp_path / "checkpoint"), once=True).awaitTermination()
        batch = normalize.with_seen(as_observations(seen)).withColumn("ts", F.when(F.col("event_id") % 50 != 0, F.col("ts")))
        want = signals.burst_density(batch.select(null_log, "MAC", "ts"), LOG, DAILY)
        got = sink.scores(spark)
        names = [LOG, "tick", "n_new", "median", "mad", "tripped"]
        assert sorted(map(str, got.select(*names).collect())) == sorted(map(str, want.select(*names).collect()))
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


class CountedState:
    """One value of a key, and how often it was asked for or set."""

    def __init__(self):
        self.value, self.calls = None, 0

    def getValueState(self, name, schema):
        return self

    def exists(self):
        self.calls += 1
        return self.value is not None

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.value, self.calls = value, self.calls + 1


def test_a_bucket_of_devices_asks_the_state_once(spark):
    from airscan.streaming.keyed import first_sighting_changes

    state, changes = CountedState(), first_sighting_changes(LOG)
    changes.init(state)

    def run(rows):
        found = changes.handleInputRows((7, 0), iter([Row(MAC=device, at=at) for device, at in rows]), None)
        return sorted((r[LOG], r.at, r.change, r.last) for r in found)

    assert run([(f"m{i}", at) for i in range(300) for at in (1000 + i, 2000)]) == [(7, 1000 + i, 1, 2000) for i in range(300)]
    assert state.calls <= 3
    assert run([("m0", 1500), ("m1", 5), ("m2", 9000), (None, 3)]) == [(7, 3, 1, 3), (7, 5, 1, 5), (7, 1001, -1, 5), (7, 1002, 0, 9000)]
    assert run([("m1", 5), (None, 3), ("m299", 1500)]) == []
    assert state.calls <= 6


def test_burst_counts_of_few_buckets_and_devices_without_name(spark, tmp_path):
    from airscan.streaming.keyed import BurstBatches

    landing, seen = str(tmp_path / "landing"), "log_no bigint, MAC string, ts timestamp"
    days = [(i % 2 or None, f"m{i % 5}" if i % 5 else None, f"2024-01-{1 + (i * 7) % 20:02d} 00:00:00") for i in range(40)]
    rows = spark.createDataFrame(days, "log_no bigint, MAC string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    rows.repartition(4).write.parquet(landing)
    want = signals.burst_density(rows, LOG, DAILY)
    names = [LOG, "tick", "n_new", "median", "mad", "tripped"]
    sink = BurstBatches(str(tmp_path / "ticks"), LOG, "bigint", DAILY, buckets=2)
    stream = spark.readStream.schema(seen).option("maxFilesPerTrigger", 2).parquet(landing)
    sink.start(stream, str(tmp_path / "checkpoint"), once=True).awaitTermination()
    assert sorted(map(str, sink.scores(spark).select(*names).collect())) == sorted(map(str, want.select(*names).collect()))
