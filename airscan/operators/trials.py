"""Contamination trials: was spam logged after it had been stopped, and did a second device hear it?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airscan.operators.signals import DEFAULTS, Thresholds, name_measures
from airscan.schema import MAC


BUCKETS = 16  # time buckets of a trial, at the most one more


def sightings_in_trials(df: DataFrame, trials: DataFrame) -> DataFrame:
    """Sightings in ``(stop_ts, end_ts]`` of a trial, once per trial they fall into.

    Trials are cut into a bounded number of time buckets, as wide as their length asks for (in
    powers of two).  A sighting takes part with one bucket of every width that occurs, which turns the
    range condition into an equi-join and a residual check.  Neither side is broadcast.
    """
    length = F.greatest(F.unix_seconds("end_ts") - F.unix_seconds("stop_ts"), F.lit(1))
    width = F.greatest(F.lit(0), F.ceil(F.log2(length / BUCKETS)).cast("int"))
    spans = trials.filter(F.col("stop_ts") < F.col("end_ts")).select("trial_id", "stop_ts", "end_ts", width.alias("_width"))
    widths = [row["_width"] for row in spans.select("_width").distinct().collect()]  # a power of two each: few

    def bucket(ts: Column, width: Column) -> Column:
        return F.call_function("shiftright", F.unix_seconds(ts.cast("timestamp")), width)

    buckets = F.explode(F.sequence(bucket(F.col("stop_ts"), F.col("_width")), bucket(F.col("end_ts"), F.col("_width"))))
    spans = spans.withColumn("_bucket", buckets).hint("merge")
    inside = (F.col("ts") > F.col("stop_ts")) & (F.col("ts") <= F.col("end_ts"))
    keyed = df.withColumn("_width", F.explode(F.array(*map(F.lit, widths)).cast("array<int>")))
    keyed = keyed.withColumn("_bucket", bucket(F.col("ts"), F.col("_width")))
    return keyed.join(spans, ["_width", "_bucket"]).filter(inside).drop("_width", "_bucket")


def trial_outcomes(
    test_log: DataFrame, trials: DataFrame, phrases: DataFrame, limits: Thresholds = DEFAULTS
) -> DataFrame:
    """Each trial with its spam sightings after the stop, ``clean`` if there are none.

    Spam is a name from the phrase list or a random-looking open network.  Only such
    sightings reach the join with the trials.
    """
    spam = name_measures(test_log, phrases, limits).filter(F.col("phrase").isNotNull() | F.col("tripped"))
    hits = (
        sightings_in_trials(spam, trials)
        .groupBy("trial_id")
        .agg(F.count("phrase").alias("phrase_hits"), F.count_if("tripped").alias("entropy_hits"))
    )
    clean = (F.col("phrase_hits") == 0) & (F.col("entropy_hits") == 0)
    return (
        trials.join(hits, "trial_id", "left")
        .fillna(0, ["phrase_hits", "entropy_hits"])
        .withColumn("outcome", F.when(clean, "clean").otherwise("contaminated"))
    )


def trial_summary(outcomes: DataFrame) -> DataFrame:
    """How many trials were clean, out of how many."""
    return outcomes.agg(F.count_if(F.col("outcome") == "clean").alias("clean"), F.count("*").alias("trials"))


def heard_by_truth(test_log: DataFrame, truth_log: DataFrame, tolerance_s: int) -> DataFrame:
    """Add ``corroborated``: did the ground-truth device hear the same MAC within the tolerance?

    Buckets are as wide as the tolerance.  A truth sighting in the same bucket is
    always close enough; from the buckets beside it only the nearest end counts, so the
    truth side shrinks to one row per MAC and bucket and no pairs are formed.
    """
    if tolerance_s <= 0:
        raise ValueError("tolerance_s must be positive")
    width = tolerance_s * 1_000_000

    def micros(name: str) -> Column:
        return F.unix_micros(F.col(name).cast("timestamp"))

    none = F.lit(None).cast("long")
    spans = (
        truth_log.filter(F.col("ts").isNotNull() & F.col(MAC).isNotNull())
        .withColumn("_us", micros("ts"))
        .groupBy(MAC, F.floor(F.col("_us") / width).alias("_at"))
        .agg(F.min("_us").alias("_first"), F.max("_us").alias("_last"))
    )

    def seen_from(offset: int, same: bool, before: Column, after: Column) -> Column:
        return F.struct(
            (F.col("_at") + offset).alias("_bucket"),
            F.lit(same).alias("_same"),
            before.alias("_before"),
            after.alias("_after"),
        )

    near = (
        spans.select(
            MAC,
            F.inline(
                F.array(
                    seen_from(0, True, none, none),
                    seen_from(1, False, F.col("_last"), none),
                    seen_from(-1, False, none, F.col("_first")),
                )
            ),
        )
        .groupBy(MAC, "_bucket")
        .agg(F.bool_or("_same").alias("_same"), F.max("_before").alias("_before"), F.min("_after").alias("_after"))
    )
    us = F.col("_us")
    close = F.col("_same") | (us - F.col("_before") <= width) | (F.col("_after") - us <= width)
    return (
        test_log.withColumn("_us", micros("ts"))
        .withColumn("_bucket", F.floor(us / width))
        .join(near, [MAC, "_bucket"], "left")
        .withColumn("corroborated", F.coalesce(close, F.lit(False)))
        .drop("_us", "_bucket", "_same", "_before", "_after")
    )


def corroborated(test_log: DataFrame, truth_log: DataFrame, tolerance_s: int) -> DataFrame:
    return heard_by_truth(test_log, truth_log, tolerance_s).filter("corroborated").drop("corroborated")


def uncorroborated(test_log: DataFrame, truth_log: DataFrame, tolerance_s: int) -> DataFrame:
    return heard_by_truth(test_log, truth_log, tolerance_s).filter("NOT corroborated").drop("corroborated")
