"""Streaming forms of the survey operators.

A stream carries the observation columns plus an event-time column ``ts`` of type
timestamp.  Projections, classification and phrase matching are the batch functions,
which need no state.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from airscan.functions.channels import channel_band
from airscan.operators import clusters as space
from airscan.operators.classify import classify_country_state
from airscan.operators.normalize import coerce_numbers, geolocated, keep_types, with_channel
from airscan.operators.phrases import match_phrases
from airscan.operators.signals import (
    DEFAULTS,
    Thresholds,
    burst_scores,
    churn_steps,
    combined_signals,
    consecutive_fixes,
    distinct_fixes,
    entropy_auth,
    first_sightings,
    name_measures,
    name_tallies,
    new_per_tick,
    numbered_masks,
)
from airscan.operators.templates import template_masks, template_names
from airscan.schema import LAT, LON, MAC, RSSI, TYPE
from airscan.sources.local import staged
from airscan.streaming.merged import MergedBatches, start_batches


def landing_stream(spark: SparkSession, path: str, schema: str, max_files: int | None = 1000) -> DataFrame:
    """Parquet files arriving in a folder, at most ``max_files`` per micro-batch."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(path)


def strongest_of(df: DataFrame, keys: Sequence[str] = (MAC, TYPE), ties: Sequence[Column | str] = ("ts",)) -> DataFrame:
    """Strongest sighting per device as an aggregate: the row that is least by (weakness, ties).

    Ranking windows are not allowed on streams; this form also merges.  On a stream it keeps one state row per key.
    """
    weakness = F.coalesce(-F.col(RSSI), F.lit(float("inf")))
    order = F.struct(weakness.alias("_weakness"), *ties)
    values = F.struct(*[name for name in df.columns if name not in keys])
    best = F.min_by(values, order).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best.*")


def strongest_batches(
    path: str, keys: Sequence[str] = (MAC, TYPE), ties: Sequence[Column | str] = ("ts",),
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> MergedBatches:
    """Strongest sighting per device from merged micro-batches; ``prepare`` types and selects the columns of a batch."""

    def partial(batch: DataFrame) -> DataFrame:
        return strongest_of(prepare(batch) if prepare else batch, keys, ties)

    return MergedBatches(path, partial, lambda partials: strongest_of(partials, keys, ties))


def windowed(size: str) -> list[Column]:
    """Start and end of the event-time window of a row."""
    window = F.window("ts", size)
    return [window["start"].alias("window_start"), window["end"].alias("window_end")]


def count_batches(path: str, window: str = "1 day", delay: str = "10 minutes") -> MergedBatches:
    """Geolocated sightings per time window, country and band."""
    keys = ["window_start", "window_end", "country", "band"]

    def partial(batch: DataFrame) -> DataFrame:
        placed = classify_country_state(geolocated(coerce_numbers(keep_types(batch))))
        banded = with_channel(placed).withColumn("band", channel_band(F.col("channel_int")))
        counts = banded.groupBy(*windowed(window), "country", "band").agg(F.count("*").alias("count"))
        return counts.withColumn("rows", F.col("count"))

    def merge(partials: DataFrame) -> DataFrame:
        return partials.groupBy(*keys).agg(F.sum("count").alias("count"), F.sum("rows").alias("rows"))

    return MergedBatches(path, partial, merge, delay)


def dictionary_stream(stream: DataFrame, phrases: DataFrame) -> DataFrame:
    """Canned-phrase hits; a stream-static join without state."""
    return match_phrases(stream, phrases, "inner")


def entropy_stream(stream: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Random-looking names on open networks; a projection without state."""
    return entropy_auth(stream, limits).filter("tripped")


def mask_batches(path: str, log: str, limits: Thresholds = DEFAULTS, delay: str = "10 minutes") -> MergedBatches:
    """Number masks per time window, log and prefix.

    A partial is one bit mask per 64 numbers, not a set of numbers.  The merged masks give the
    exact scores through :func:`airscan.operators.signals.numbered_names`, whatever the arrival order.
    """
    keys = ["window_start", "window_end", log, "prefix", "high", "block"]

    def partial(batch: DataFrame) -> DataFrame:
        return numbered_masks(batch, [*windowed(limits.window), log], F.count("*").alias("rows"))

    def merge(partials: DataFrame) -> DataFrame:
        return partials.groupBy(*keys).agg(F.bit_or("own").alias("own"), F.sum("rows").alias("rows"))

    return MergedBatches(path, partial, merge, delay)


def merged_masks(partials: DataFrame, keys: list[str]) -> DataFrame:
    """Template masks of the same numbers put together."""
    return partials.groupBy(*keys, "kind", "prefix", "high", "block").agg(F.bit_or("own").alias("own"), F.bit_or("marks").alias("marks"))


def template_batches(path: str, log: str, limits: Thresholds = DEFAULTS, delay: str = "10 minutes") -> MergedBatches:
    """Number masks per time window, log and template; ``rows`` counts slots, of which a name may have several.

    The merged masks give the exact scores through :func:`airscan.operators.templates.template_names`.
    """
    keys = ["window_start", "window_end", log, "kind", "prefix", "high", "block"]

    def partial(batch: DataFrame) -> DataFrame:
        return template_masks(batch, [*windowed(limits.window), log], F.count("*").alias("rows"))

    def merge(partials: DataFrame) -> DataFrame:
        return partials.groupBy(*keys).agg(
            F.bit_or("own").alias("own"), F.bit_or("marks").alias("marks"), F.sum("rows").alias("rows")
        )

    return MergedBatches(path, partial, merge, delay)


def first_sighting_batches(path: str, log: str) -> MergedBatches:
    """First and last time per log and device.

    The burst score needs a log's whole distribution, so it is taken from the merged result
    with :func:`airscan.operators.signals.burst_scores`.
    """

    def merge(partials: DataFrame) -> DataFrame:
        return partials.groupBy(log, MAC).agg(F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))

    return MergedBatches(path, lambda batch: first_sightings(batch, log), merge)


def merged_tallies(partials: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    """Tallies of both name modules put together."""
    return partials.groupBy(*keys).agg(
        F.sum("phrase_hits").alias("phrase_hits"), F.min("phrase_example").alias("phrase_example"),
        F.sum("entropy_hits").alias("entropy_hits"), F.max("entropy_max").alias("entropy_max"), *more,
    )


def name_tally_batches(
    path: str, phrases: DataFrame, log: str, limits: Thresholds = DEFAULTS, delay: str = "10 minutes"
) -> MergedBatches:
    """Tallies of both name modules per log and time window."""

    def partial(batch: DataFrame) -> DataFrame:
        measured = name_measures(batch, phrases, limits)
        return measured.groupBy(*windowed(limits.window), log).agg(*name_tallies(), F.count("*").alias("rows"))

    def merge(partials: DataFrame) -> DataFrame:
        return merged_tallies(partials, ["window_start", "window_end", log], F.sum("rows").alias("rows"))

    return MergedBatches(path, partial, merge, delay)


class ChurnBatches:
    """Position churn over micro-batches.

    A fix that follows the last one of its log (by time, then position) opens a step at once; the last
    fix of every log is written beside the batch and opens the next one.  A fix that comes later than
    its place is written to a late output, and ``steps`` orders the fixes of such logs anew, so the
    steps are those of a batch run whatever the order of arrival.  All folders are named by
    batch id, so a replayed batch starts from the same state.
    """

    FIX = "ts timestamp, lat double, lon double"

    def __init__(self, path: str, log: str, log_type: str = "string", limits: Thresholds = DEFAULTS):
        self.path, self.log, self.log_type, self.limits = path, log, log_type, limits

    def _carried(self, spark: SparkSession, batch_id: int) -> DataFrame:
        if batch_id == 0:
            return spark.createDataFrame([], f"`{self.log}` {self.log_type}, {self.FIX}")
        return spark.read.parquet(f"{self.path}/state/batch={batch_id - 1}")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, log = batch.sparkSession, self.log
        fix = F.struct("ts", "lat", "lon")
        carried = self._carried(spark, batch_id)
        last = carried.select(F.col(log).alias("_log"), fix.alias("_last"))
        fresh = distinct_fixes(batch, log).join(last, F.col(log).eqNullSafe(F.col("_log")), "left").drop("_log")
        # Written once: the steps, the new state and the late output read the fixes of the batch.
        marked = fresh.withColumn("late", F.coalesce(fix < F.col("_last"), F.lit(False)))
        marked = marked.filter(F.col("_last").isNull() | (fix != F.col("_last"))).drop("_last")
        marked = marked.unionByName(carried.withColumn("late", F.lit(False)))
        marked.write.mode("overwrite").parquet(f"{self.path}/fixes/batch={batch_id}")
        marked = spark.read.parquet(f"{self.path}/fixes/batch={batch_id}")
        fixes = marked.filter("NOT late").drop("late")
        steps = churn_steps(consecutive_fixes(fixes, log, self.limits.churn_chunk_s, self.limits.churn_chunk_fixes), self.limits)
        steps.write.mode("overwrite").parquet(f"{self.path}/steps/batch={batch_id}")
        ends = fixes.groupBy(log).agg(F.max(fix).alias("_end")).select(log, "_end.*")
        ends.write.mode("overwrite").parquet(f"{self.path}/state/batch={batch_id}")

    def start(self, stream: DataFrame, checkpoint: str, once: bool = False) -> StreamingQuery:
        return start_batches(stream, self, checkpoint, once)

    def late(self, spark: SparkSession) -> DataFrame:
        """How many fixes of each log came after a later one."""
        fixes = spark.read.parquet(f"{self.path}/fixes").filter("late")
        return fixes.groupBy(self.log).agg(F.count("*").alias("late_fixes"))

    def steps(self, spark: SparkSession) -> DataFrame:
        """All steps so far; logs with late fixes are put in order anew from all their fixes."""
        log = self.log
        torn = staged(self.late(spark).select(F.col(log).alias("_log")), "late-logs")
        same = F.col(log).eqNullSafe(F.col("_log"))
        emitted = spark.read.parquet(f"{self.path}/steps").drop("batch").join(torn, same, "left_anti")
        fixes = spark.read.parquet(f"{self.path}/fixes").drop("batch", "late").join(torn, same, "left_semi").distinct()
        repaired = churn_steps(consecutive_fixes(fixes, log, self.limits.churn_chunk_s, self.limits.churn_chunk_fixes), self.limits)
        return emitted.unionByName(repaired)


class SignalBatches:
    """All five modules from one stream: the merged measures give the signals and the report at any time."""

    def __init__(
        self, path: str, phrases: DataFrame, log: str, log_type: str = "string", limits: Thresholds = DEFAULTS,
        delay: str = "10 minutes",
    ):
        self.log, self.limits = log, limits
        self.names = name_tally_batches(f"{path}/names", phrases, log, limits, delay)
        self.numbers = template_batches(f"{path}/numbers", log, limits, delay)
        self.first = first_sighting_batches(f"{path}/first", log)
        self.churn = ChurnBatches(f"{path}/churn", log, log_type, limits)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        for part in (self.names, self.numbers, self.first, self.churn):
            part(batch, batch_id)

    def start(self, stream: DataFrame, checkpoint: str, once: bool = False) -> StreamingQuery:
        return start_batches(stream, self, checkpoint, once)

    def signals(self, spark: SparkSession) -> DataFrame:
        log, limits = self.log, self.limits
        numbered = template_names(self.numbers.result(spark), [log, "window_start"], limits)
        bursts = burst_scores(new_per_tick(self.first.result(spark), log, limits.burst_tick_s), log, limits)
        return combined_signals(self.names.result(spark), numbered, bursts, self.churn.steps(spark), log, limits)


class ClusterSignalBatches:
    """The report per log, cluster and window from one stream.

    Clusters are known only from all sightings, so the partials are kept by cell: tallies, masks, first sightings and the
    number of sightings of every cell merge in any order. Clusters are drawn from the merged cells when results are read,
    and the cells' measures are put together by cluster then.
    """

    CELL = "_cell"

    def __init__(
        self, path: str, phrases: DataFrame, log: str, log_type: str = "string", limits: Thresholds = DEFAULTS,
        delay: str = "10 minutes",
    ):
        self.log, self.limits = log, limits
        self.names = name_tally_batches(f"{path}/names", phrases, self.CELL, limits, delay)
        self.numbers = template_batches(f"{path}/numbers", self.CELL, limits, delay)
        self.cells = MergedBatches(f"{path}/cells", self._cells, lambda rows: rows.groupBy(self.CELL).agg(F.sum("n").alias("n")))
        self.first = MergedBatches(f"{path}/first", self._first, self._earliest)
        self.churn = ChurnBatches(f"{path}/churn", log, log_type, limits)

    def _celled(self, batch: DataFrame) -> DataFrame:
        cell = space.cell_of(F.col(LAT), F.col(LON), F.col("ts"), self.limits)
        return batch.withColumn(self.CELL, F.struct(F.col(self.log).alias("log"), *cell))

    def _cells(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(self.CELL).agg(F.count("*").alias("n"))

    def _earliest(self, partials: DataFrame) -> DataFrame:
        at = F.struct("first_ts", self.CELL)
        return partials.groupBy("log", MAC).agg(
            F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.min_by(self.CELL, at).alias(self.CELL)
        )

    def _first(self, rows: DataFrame) -> DataFrame:
        seen = rows.select(F.col(f"{self.CELL}.log").alias("log"), MAC, F.col("ts").alias("first_ts"), F.col("ts").alias("last_ts"), self.CELL)
        return self._earliest(seen)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        celled = self._celled(batch)
        for part in (self.names, self.numbers, self.cells, self.first):
            part(celled, batch_id)
        self.churn(batch, batch_id)

    def start(self, stream: DataFrame, checkpoint: str, once: bool = False) -> StreamingQuery:
        return start_batches(stream, self, checkpoint, once)

    def signals(self, spark: SparkSession) -> DataFrame:
        """All modules per log and cluster (``where``) and time window in the long form."""
        log, limits, cell = self.log, self.limits, [F.col(f"{self.CELL}.{n}") for n in space.CELL]
        placed = self.cells.result(spark).select(F.col(f"{self.CELL}.log").alias(log), *cell, "n").filter("x is not null")
        found = space.clusters(placed, log, limits)

        def clustered(rows: DataFrame, position: list[Column]) -> DataFrame:
            return space.with_cluster(rows, found, log, position).withColumn("where", space.where(log))

        def by_log(rows: DataFrame) -> DataFrame:
            return clustered(rows.withColumn(log, F.col(f"{self.CELL}.log")).withColumnRenamed(self.CELL, "_at"),
                             [F.col(f"_at.{n}").alias(n) for n in space.CELL])

        keys = ["where", "window_start"]
        tallies = merged_tallies(by_log(self.names.result(spark)), keys)
        numbered = template_names(merged_masks(by_log(self.numbers.result(spark)), keys), keys, limits)
        first = by_log(self.first.result(spark).withColumnRenamed("log", "_log_of"))
        steps = clustered(self.churn.steps(spark), space.cell_of(F.col("lat"), F.col("lon"), F.col("ts"), limits))
        return combined_signals(tallies, numbered, space.cluster_bursts(first, log, limits), steps, "where", limits)
