"""Five independent signals of spoofed beacons and their report.

Signals look at raw sightings; removing duplicates first would destroy the time
series.  Thresholds are parameters.  Every module ends in the same long form,
one row per log and time window: ``(log, window_start, module, score, tripped, reason)``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airscan.functions.geo import haversine_m
from airscan.functions.numbers import round_half_even
from airscan.functions.text import LOW_BLOCKS, char_entropy, is_numbered, number_block, number_prefix, one_less, trailing_digits
from airscan.operators.normalize import is_open
from airscan.operators.phrases import match_phrases
from airscan.schema import AUTH, LAT, LON, MAC, SSID

MASK_BITS = 64


@dataclass(frozen=True)
class Thresholds:
    window: str = "10 minutes"
    min_phrase_hits: int = 1
    min_numbers: int = 5
    min_run: int = 4
    min_lines: int = 5
    min_length: int = 8
    min_entropy_ratio: float = 0.9
    burst_tick_s: int = 1
    burst_min_new: int = 5
    burst_min_score: float = 6.0
    burst_min_scale: float = 1.0
    max_speed_mps: float = 90.0
    churn_chunk_s: int = 3600
    churn_chunk_fixes: int = 100_000
    cluster_deg: float = 0.005
    cluster_slot_s: int = 600
    cluster_min: int = 5


DEFAULTS = Thresholds()


def window_start(ts: str = "ts", size: str = DEFAULTS.window) -> Column:
    return F.window(ts, size)["start"]


# -- dictionary ---------------------------------------------------------------


def dictionary_hits(df: DataFrame, phrases: DataFrame) -> DataFrame:
    """Sightings whose name is a canned phrase, with the phrase and its pack."""
    return match_phrases(df, phrases, "inner")


# -- numbered names -----------------------------------------------------------


def numbered_masks(df: DataFrame, keys: list[Column | str], *more: Column) -> DataFrame:
    """Trailing numbers seen per key and prefix, as 64-number bit masks (``high``, ``block``, ``own``), and more aggregates.

    Masks combine by ``bit_or`` before the shuffle; no prefix is gathered in one task.
    """
    high, block, place = number_block(F.col("_digits"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place)
    return (
        df.filter(is_numbered(F.col(SSID)))
        .withColumns({"prefix": number_prefix(F.col(SSID)), "_digits": trailing_digits(F.col(SSID))})
        .groupBy(*keys, "prefix", high.alias("high"), block.alias("block"))
        .agg(F.bit_or(bit).alias("own"), *more)
    )


def with_following(masks: DataFrame, keys: list[str], length: int, *more: Column) -> DataFrame:
    """Each mask with the masks of as many following blocks as a run of ``length`` can reach, as an array; and more aggregates.

    Every mask is handed to the blocks before it, so runs cross any number of blocks without
    ordering a prefix's numbers.  Blocks are counted on over the border of 18 digits.
    """
    reach = -(-(length - 1) // MASK_BITS)
    target = F.col("block") - F.col("_back")
    below = target < 0
    high = F.when(~below, F.col("high")).otherwise(one_less(F.col("high")))
    handed = (
        masks.withColumn("_back", F.explode(F.sequence(F.lit(0), F.lit(reach))))
        .withColumns({"_high": high, "_block": F.when(below, target + LOW_BLOCKS).otherwise(target)})
        .filter(F.col("_high").isNotNull())
    )
    words = [F.coalesce(F.bit_or(F.when(F.col("_back") == i, F.col("own"))), F.lit(0)) for i in range(reach + 2)]
    grouped = handed.groupBy(*keys, "prefix", "_high", "_block").agg(F.array(*words).alias("words"), *more)
    return grouped.filter(F.get("words", F.lit(0)) != 0)


def run_starts(words: Column, length: int) -> Column:
    """How many numbers of the first mask begin a run of ``length`` consecutive numbers."""

    def ahead(step: Column) -> Column:
        skip, shift = F.call_function("div", step, F.lit(MASK_BITS)), (step % MASK_BITS).cast("int")
        near = F.call_function("shiftrightunsigned", F.get(words, skip), shift)
        far = F.call_function("shiftleft", F.get(words, skip + 1), MASK_BITS - shift)
        return F.when(shift == 0, F.get(words, skip)).otherwise(near.bitwiseOR(far))

    if length < 2:
        return F.bit_count(F.get(words, F.lit(0)))
    steps = F.sequence(F.lit(1), F.lit(length - 1))
    return F.bit_count(F.aggregate(steps, F.get(words, F.lit(0)), lambda mask, step: mask.bitwiseAND(ahead(step))))


def numbered_names(masks: DataFrame, keys: list[str], limits: Thresholds = DEFAULTS) -> DataFrame:
    """Distinct numbers and run starts per key and prefix, tripped by many numbers or one long run."""
    return (
        with_following(masks, keys, limits.min_run)
        .groupBy(*keys, "prefix")
        .agg(
            F.sum(F.bit_count(F.get("words", F.lit(0)))).cast("long").alias("n_numbers"),
            F.sum(run_starts(F.col("words"), limits.min_run)).cast("long").alias("n_run_starts"),
        )
        .withColumn("tripped", (F.col("n_numbers") >= limits.min_numbers) | (F.col("n_run_starts") >= 1))
    )


def sequential(df: DataFrame, log: str, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Numbered-name score per log, time window and prefix."""
    keys = [log, "window_start"]
    windowed = df.withColumn("window_start", window_start(size=limits.window))
    return numbered_names(numbered_masks(windowed, keys), keys, limits)


# -- entropy and authentication -----------------------------------------------


def entropy_auth(df: DataFrame, limits: Thresholds = DEFAULTS, auth: str = AUTH, pattern: str = "[OPEN]") -> DataFrame:
    """Add name entropy in bits, its ratio to the maximum for the length, and the verdict.

    Only a random-looking name on an open network trips; an encrypted one never does.
    """
    length = F.length(SSID)
    candidate = is_open(auth, pattern) & (length >= limits.min_length)
    ratio = F.when(length > 1, F.col("entropy") / F.log2(length))
    return (
        df.withColumn("entropy", F.when(candidate, char_entropy(F.col(SSID))))
        .withColumn("entropy_ratio", ratio)
        .withColumn("tripped", F.coalesce(F.col("entropy_ratio") >= limits.min_entropy_ratio, F.lit(False)))
    )


# -- bursts of new devices ----------------------------------------------------


def first_sightings(df: DataFrame, log: str) -> DataFrame:
    """First and last time of every device of a log."""
    return df.groupBy(log, MAC).agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def new_per_tick(first: DataFrame, log: str, tick_s: int) -> DataFrame:
    """Devices first seen per log and tick (ticks are numbered since the epoch)."""
    tick = F.floor(F.unix_seconds(F.col("first_ts").cast("timestamp")) / tick_s)
    last = F.floor(F.unix_seconds(F.col("last_ts").cast("timestamp")) / tick_s)
    return (
        first.filter(F.col("first_ts").isNotNull())
        .groupBy(log, tick.alias("tick"))
        .agg(F.count("*").alias("n_new"), F.max(last).alias("_last_tick"))
    )


def tick_histogram(per_tick: DataFrame, log: str) -> DataFrame:
    """How many ticks of a log had 0, 1, 2 … new devices, over the log's whole span."""
    busy = per_tick.groupBy(log, "n_new").agg(
        F.count("*").alias("n_ticks"), F.min("tick").alias("_from"), F.max("_last_tick").alias("_to")
    )
    idle = busy.groupBy(log).agg(
        F.lit(0).cast("long").alias("n_new"),
        (F.max("_to") - F.min("_from") + 1 - F.sum("n_ticks")).alias("n_ticks"),
    )
    return busy.select(log, "n_new", "n_ticks").unionByName(idle.filter(F.col("n_ticks") > 0))


def join_log(df: DataFrame, per_log: DataFrame, log: str) -> DataFrame:
    """Join one row per log to its rows; rows without a log are one log, as in any grouping."""
    other = per_log.withColumnRenamed(log, "_log")
    return df.join(other, F.col(log).eqNullSafe(F.col("_log"))).drop("_log")


def burst_baseline(histogram: DataFrame, log: str) -> DataFrame:
    """Median and median absolute deviation of new devices per tick, idle ticks included."""
    middle = F.percentile("n_new", F.lit(0.5), F.col("n_ticks"))
    medians = histogram.groupBy(log).agg(middle.alias("median"))
    return (
        join_log(histogram, medians, log)
        .groupBy(log, "median")
        .agg(F.percentile(F.abs(F.col("n_new") - F.col("median")), F.lit(0.5), F.col("n_ticks")).alias("mad"))
    )


def burst_scores(per_tick: DataFrame, log: str, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Robust score of every tick with new devices against its log's own distribution."""
    scale = F.greatest(F.lit(1.4826) * F.col("mad"), F.lit(limits.burst_min_scale))
    score = (F.col("n_new") - F.col("median")) / scale
    baseline = burst_baseline(tick_histogram(per_tick, log), log)
    return (
        join_log(per_tick.drop("_last_tick"), baseline, log)
        .withColumn("score", score)
        .withColumn(
            "tripped",
            (F.col("n_new") >= limits.burst_min_new) & (F.col("score") >= limits.burst_min_score),
        )
    )


def burst_density(df: DataFrame, log: str, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Rate of new devices per log and tick, scored against the log itself."""
    per_tick = new_per_tick(first_sightings(df, log), log, limits.burst_tick_s)
    return burst_scores(per_tick, log, limits)


# -- position churn -----------------------------------------------------------


def distinct_fixes(df: DataFrame, log: str) -> DataFrame:
    """Distinct positions per log and instant; many sightings share one fix."""
    return (
        df.filter(F.col("ts").isNotNull() & F.col(LAT).isNotNull() & F.col(LON).isNotNull())
        .select(log, F.col("ts").cast("timestamp").alias("ts"), F.col(LAT).alias("lat"), F.col(LON).alias("lon"))
        .distinct()
    )


def chunked_fixes(fixes: DataFrame, log: str, chunk_s: int, most: int) -> DataFrame:
    """Add ``_chunk``: time slices in order, of ``chunk_s`` seconds, or finer where a log has over ``most`` fixes in one."""
    micros = F.unix_micros("ts")
    slice_us = chunk_s * 1_000_000
    cut = fixes.withColumn("_slice", F.floor(micros / slice_us))
    dense = cut.groupBy(log, "_slice").agg(F.count("*").alias("_n")).filter(F.col("_n") > most)
    halvings = F.least(F.lit(31), F.ceil(F.log2(F.col("_n") / most))).cast("int")
    dense = dense.select(F.col(log).alias("_dense_log"), F.col("_slice").alias("_dense"), halvings.alias("_halvings"))
    same = F.col(log).eqNullSafe(F.col("_dense_log")) & (F.col("_slice") == F.col("_dense"))
    inner = F.pmod(micros, F.lit(slice_us)) / slice_us * F.call_function("power", F.lit(2), F.coalesce("_halvings", F.lit(0)))
    return cut.join(dense, same, "left").withColumn(
        "_chunk", F.struct(F.col("_slice").alias("slice"), F.floor(inner).alias("part"))
    ).drop("_slice", "_dense", "_dense_log", "_halvings")


def consecutive_fixes(
    fixes: DataFrame, log: str, chunk_s: int = DEFAULTS.churn_chunk_s, most: int = DEFAULTS.churn_chunk_fixes
) -> DataFrame:
    """Each fix with the one before it in its log (``prev.ts``, ``prev.lat``, ``prev.lon``).

    A log may hold a third of all rows, so it is not ordered as one group: fixes are
    ordered inside time chunks, and only the last fix of each chunk is ordered along
    the whole log to supply the first fix of the next chunk.
    """
    fix = F.struct("ts", "lat", "lon")
    inside = Window.partitionBy(log, "_chunk").orderBy("ts", "lat", "lon")
    chunked = chunked_fixes(fixes, log, chunk_s, most)
    ordered = chunked.withColumns({"_inside": F.lag(fix).over(inside), "_next": F.lead("ts").over(inside)})
    along = Window.partitionBy("_end_log").orderBy("_end_chunk")
    ends = (
        ordered.filter(F.col("_next").isNull())
        .select(F.col(log).alias("_end_log"), F.col("_chunk").alias("_end_chunk"), fix.alias("_end"))
        .withColumn("_carry", F.lag("_end").over(along))
        .drop("_end")
    )
    same_chunk = F.col(log).eqNullSafe(F.col("_end_log")) & (F.col("_chunk") == F.col("_end_chunk"))
    return (
        ordered.join(ends, same_chunk)
        .withColumn("prev", F.coalesce("_inside", "_carry"))
        .drop("_inside", "_next", "_carry", "_chunk", "_end_log", "_end_chunk")
    )


def churn_steps(steps: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Distance, elapsed time and implied speed of each step; a move in no time has no speed but trips."""
    distance = haversine_m(F.col("prev.lat"), F.col("prev.lon"), F.col("lat"), F.col("lon"))
    elapsed = (F.unix_micros("ts") - F.unix_micros("prev.ts")) / F.lit(1e6)
    return (
        steps.filter(F.col("prev").isNotNull())
        .withColumns({"distance_m": distance, "elapsed_s": elapsed})
        .withColumn("speed_mps", F.try_divide("distance_m", "elapsed_s"))
        .withColumn("tripped", (F.col("elapsed_s") == 0) | (F.col("speed_mps") > limits.max_speed_mps))
        .drop("prev")
    )


def gps_churn(df: DataFrame, log: str, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Implied speed between consecutive distinct fixes of a log."""
    return churn_steps(consecutive_fixes(distinct_fixes(df, log), log, limits.churn_chunk_s, limits.churn_chunk_fixes), limits)


# -- report -------------------------------------------------------------------


def _signals(scored: DataFrame, log: str, module: str, score: Column, tripped: Column, reason: Column) -> DataFrame:
    """One module's aggregate per log and window in the long form."""
    return scored.groupBy(log, "window_start").agg(
        F.lit(module).alias("module"),
        score.cast("double").alias("score"),
        F.coalesce(tripped, F.lit(False)).alias("tripped"),
        reason.alias("reason"),
    )


def name_measures(df: DataFrame, phrases: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Row-level measures of both name modules; one pass over the sightings serves both."""
    return entropy_auth(match_phrases(df, phrases, "left"), limits)


def name_tallies() -> list[Column]:
    """Aggregates of :func:`name_measures`, usable in batch and on streams."""
    return [
        F.count("phrase").alias("phrase_hits"),
        F.min("phrase").alias("phrase_example"),
        F.count_if("tripped").alias("entropy_hits"),
        F.max(F.when(F.col("tripped"), F.col("entropy_ratio"))).alias("entropy_max"),
    ]


def name_signals(tallies: DataFrame, log: str, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Tallies per log and window as the two name modules' signals."""

    def entry(module: str, score: Column, tripped: Column, reason: Column) -> Column:
        return F.struct(
            F.lit(module).alias("module"),
            score.cast("double").alias("score"),
            tripped.alias("tripped"),
            reason.alias("reason"),
        )

    hits, random = F.col("phrase_hits"), F.col("entropy_hits")
    entries = F.array(
        entry(
            "dictionary",
            hits,
            hits >= limits.min_phrase_hits,
            F.when(hits > 0, F.concat(hits.cast("string"), F.lit(" names from a phrase list, e.g. "), "phrase_example")),
        ),
        entry(
            "entropy",
            random,
            random >= 1,
            F.when(random > 0, F.concat(random.cast("string"), F.lit(" random-looking open networks"))),
        ),
    )
    return tallies.select(log, "window_start", F.inline(entries))


def combined_signals(
    tallies: DataFrame, numbered: DataFrame, bursts: DataFrame, steps: DataFrame, log: str, limits: Thresholds = DEFAULTS
) -> DataFrame:
    """The five modules' measures, from a batch or folded from streams, in the long form."""
    start = window_start(size=limits.window)
    numbers = F.max("n_numbers")
    tripped = F.bool_or("tripped")
    parts = [
        name_signals(tallies, log, limits),
        _signals(
            numbered, log, "sequential", numbers, tripped,
            F.concat(numbers.cast("string"), F.lit(" numbers behind one prefix")),
        ),
        _signals(
            _burst_windows(bursts, limits), log, "burst", round_half_even(F.max("score"), 6), tripped,
            F.concat(F.max("n_new").cast("string"), F.lit(" new devices in one tick")),
        ),
        _signals(
            steps.withColumn("window_start", start), log, "gps_churn", F.count_if("tripped"), tripped,
            F.concat(F.count_if("tripped").cast("string"), F.lit(" implausible moves")),
        ),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def all_signals(df: DataFrame, phrases: DataFrame, log: str, limits: Thresholds = DEFAULTS) -> DataFrame:
    """All five modules per log and window in the long form; names are tried against templates with a counter anywhere."""
    from airscan.operators.templates import templates

    tallies = (
        name_measures(df, phrases, limits)
        .groupBy(log, window_start(size=limits.window).alias("window_start"))
        .agg(*name_tallies())
    )
    return combined_signals(
        tallies, templates(df, log, limits), burst_density(df, log, limits), gps_churn(df, log, limits), log, limits
    )


def _burst_windows(scores: DataFrame, limits: Thresholds) -> DataFrame:
    at = F.timestamp_seconds(F.col("tick") * limits.burst_tick_s)
    return scores.withColumn("_at", at).withColumn("window_start", window_start("_at", limits.window)).drop("_at")


def report(signals: DataFrame, log: str) -> DataFrame:
    """One row per log and window where something tripped: which modules, and why.

    A group holds at most one row per module.  The report names signals only and does
    not decide who is at fault.
    """
    fired = F.struct("module", "score", "reason")
    return (
        signals.filter("tripped")
        .groupBy(log, "window_start")
        .agg(F.array_sort(F.collect_list(fired)).alias("signals"))
        .withColumn("n_signals", F.size("signals"))
        .withColumn("modules", F.array_join("signals.module", ","))
    )
