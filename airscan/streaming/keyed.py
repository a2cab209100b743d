"""Streams with keyed state that lies on the executors' disks and is saved with every micro-batch."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from airscan.operators.signals import DEFAULTS, Thresholds, burst_scores, join_log
from airscan.schema import MAC
from airscan.streaming.merged import MergedBatches

STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB; the session's own settings come back afterwards."""
    before = {key: spark.conf.get(key, None) for key in STATE}
    for key, value in STATE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


BUCKET = "_bucket"


def first_sighting_changes(log: str) -> StatefulProcessor:
    """Per log and device the earliest and latest time; a device that is new, or seen earlier than known, changes a count.

    A key is a bucket of devices, whose times lie in one value: a worker asks the state once per bucket and micro-batch, not
    several times per device. The class is made here so that workers need nothing of this package.
    """

    class Changes(StatefulProcessor):
        def init(self, handle) -> None:
            self.seen = handle.getValueState("seen", "device array<string>, first array<bigint>, last array<bigint>")

        def handleInputRows(self, key, rows, timer_values):
            from pyspark.sql import Row

            span = {}
            for row in rows:
                device, at = row[MAC], row["at"]
                first, last = span.get(device, (at, at))
                span[device] = (at if at < first else first, at if at > last else last)
            state = self.seen.get() if span else None
            known = {} if state is None else {device: (first, last) for device, first, last in zip(*state, strict=True)}
            moved = False
            for device, (first, last) in span.items():
                was = known.get(device)
                if was is not None and was[0] <= first and was[1] >= last:
                    continue
                moved = True
                if was is None or first < was[0]:
                    yield Row(**{log: key[0], "at": first, "change": 1, "last": last})
                    if was is not None:
                        yield Row(**{log: key[0], "at": was[0], "change": -1, "last": last})
                else:
                    yield Row(**{log: key[0], "at": was[0], "change": 0, "last": last})
                known[device] = (first, last) if was is None else (min(first, was[0]), max(last, was[1]))
            if moved:
                times = known.values()
                self.seen.update((list(known), [first for first, _ in times], [last for _, last in times]))

        def close(self) -> None:
            pass

    return Changes()


class BurstBatches:
    """Bursts of new devices from a stream in any order, with a count per tick that can be taken back.

    The keyed state knows every device's earliest time so far. A sighting that moves it takes one from the old tick and adds
    one to the new one, so the counts per tick are always those of all rows so far. Results read the counts of ticks only,
    never the devices; the baseline of a log comes from the histogram of its ticks.

    The devices of a log are dealt over ``buckets`` keys by hash. A bucket that a micro-batch touches is read, and written
    again if a time moved, so more devices per log want more buckets; a checkpoint keeps the number it was started with.
    """

    def __init__(self, path: str, log: str, log_type: str = "string", limits: Thresholds = DEFAULTS, buckets: int = 1024):
        self.log, self.log_type, self.limits, self.buckets = log, log_type, limits, buckets
        self.ticks = MergedBatches(path, self._partial, self._merge)

    def _partial(self, changes: DataFrame) -> DataFrame:
        def tick(name: str):
            return F.floor(F.col(name) / 1_000_000 / self.limits.burst_tick_s)

        return changes.groupBy(self.log, tick("at").alias("tick")).agg(
            F.sum("change").cast("long").alias("n_new"), F.max(tick("last")).alias("last_tick")
        )

    def _merge(self, partials: DataFrame) -> DataFrame:
        return partials.groupBy(self.log, "tick").agg(F.sum("n_new").alias("n_new"), F.max("last_tick").alias("last_tick"))

    def start(self, stream: DataFrame, checkpoint: str, once: bool = False) -> StreamingQuery:
        bucket = F.pmod(F.xxhash64(MAC), F.lit(self.buckets)).alias(BUCKET)
        rows = stream.filter("ts is not null").select(self.log, bucket, MAC, F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
        schema = f"`{self.log}` {self.log_type}, at bigint, change int, last bigint"
        changes = rows.groupBy(self.log, BUCKET).transformWithState(first_sighting_changes(self.log), schema, "Update", "None")
        with state_on_disk(stream.sparkSession):
            writer = changes.writeStream.outputMode("update").foreachBatch(self.ticks).option("checkpointLocation", checkpoint)
            return (writer.trigger(availableNow=True) if once else writer).start()

    def per_tick(self, spark: SparkSession) -> DataFrame:
        """Devices first seen per log and tick so far, and the log's last tick."""
        counts = self.ticks.result(spark)
        ends = counts.groupBy(self.log).agg(F.max("last_tick").alias("_last_tick"))
        return join_log(counts.filter("n_new > 0").drop("last_tick"), ends, self.log)

    def scores(self, spark: SparkSession) -> DataFrame:
        """Every tick with new devices against its log's own distribution so far."""
        return burst_scores(self.per_tick(spark), self.log, self.limits)
