"""Counts per type, region, band and channel, and the stage funnel."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from airscan.functions.channels import channel_band, channel_group, channel_mhz
from airscan.functions.text import normalize_type
from airscan.operators.normalize import has_position, type_set, with_channel
from airscan.schema import DEFAULT_TYPES, TYPE


def count_by(df: DataFrame, name: str) -> DataFrame:
    """Rows per value, most frequent first, ties by name."""
    return df.groupBy(name).agg(F.count("*").alias("count")).orderBy(F.desc("count"), name)


def top_countries(df: DataFrame, n: int = 15) -> DataFrame:
    return count_by(df, "country").limit(n)


def both_levels(df: DataFrame) -> DataFrame:
    """Each classified row once under its country and, in the USA, once more under its state."""
    levels = F.array(
        F.struct(F.lit("country").alias("level"), F.col("country").alias("region")),
        F.struct(F.lit("us_state").alias("level"), F.col("state").alias("region")),
    )
    return (
        df.withColumn("_level", F.explode(levels))
        .select("*", "_level.level", "_level.region")
        .drop("_level")
        .filter(F.col("region").isNotNull())
    )


def channel_cube(df: DataFrame) -> DataFrame:
    """WiFi rows counted per country, state and channel: the one shuffle all channel summaries share."""
    wifi = with_channel(df.filter(F.col(TYPE) == "WIFI"))
    return wifi.groupBy("country", "state", "channel_int").agg(F.count("*").alias("count"))


def band_summary(cube: DataFrame) -> DataFrame:
    """Band counts per country and state, unknown included, with the WiFi total of the region."""
    bands = [("2.4GHz", "n_24"), ("5GHz", "n_5"), ("unknown", "n_unknown")]
    tally = (
        both_levels(cube.withColumn("band", channel_band(F.col("channel_int"))))
        .groupBy("level", "region")
        .agg(
            F.sum("count").alias("wifi_total"),
            *[F.sum(F.when(F.col("band") == band, F.col("count"))).alias(name) for band, name in bands],
        )
    )
    rows = F.array(*[F.struct(F.lit(band).alias("band"), F.col(name).alias("count")) for band, name in bands])
    return (
        tally.select("level", "region", "wifi_total", F.inline(rows))
        .filter(F.col("count").isNotNull())
        .select("level", "region", "band", "count", "wifi_total")
    )


def channel_summary(cube: DataFrame, strict: bool = False) -> DataFrame:
    """Counts per country or state and channel; rows without a channel are left out."""
    channel = F.col("channel_int")
    return (
        both_levels(cube.filter(channel.isNotNull()))
        .groupBy("level", "region", "channel_int")
        .agg(F.sum("count").alias("count"))
        .select(
            "level",
            "region",
            "channel_int",
            channel_band(channel).alias("band"),
            channel_group(channel, strict).alias("channel_group"),
            "count",
        )
    )


def group_rollup(df: DataFrame, strict: bool = False) -> DataFrame:
    """WiFi rows rolled up band > channel group > channel; ``depth`` is the number of levels kept (0 = total)."""
    channel = F.col("channel_int")
    counts = (
        with_channel(df.filter(F.col(TYPE) == "WIFI"))
        .filter(channel.isNotNull())
        .groupBy("channel_int")
        .agg(F.count("*").alias("n"))
        .withColumns({"band": channel_band(channel), "channel_group": channel_group(channel, strict)})
    )
    kept = {0: 3, 1: 2, 3: 1, 7: 0}
    depth = F.create_map(*[F.lit(x) for item in kept.items() for x in item])
    return (
        counts.rollup("band", "channel_group", "channel_int")
        .agg(F.sum("n").alias("count"), F.grouping_id().alias("_gid"))
        .withColumn("depth", F.element_at(depth, F.col("_gid").cast("int")))
        .drop("_gid")
    )


def channel_frequency(df: DataFrame) -> DataFrame:
    """WiFi rows per 2.4 GHz channel with its centre frequency."""
    number = channel_mhz(F.col("channel_int"))
    return (
        with_channel(df.filter(F.col(TYPE) == "WIFI"))
        .withColumn("mhz", number)
        .filter(F.col("mhz").isNotNull())
        .groupBy(F.col("channel_int").cast("int").alias("channel"), "mhz")
        .agg(F.count("*").alias("count"))
    )


def region_names(classified: DataFrame) -> DataFrame:
    """Distinct regions and states, which is the list of split outputs, in alphabetical order."""
    return both_levels(classified).select("level", "region").distinct().orderBy("level", "region")


def region_totals(classified: DataFrame) -> DataFrame:
    """Number of distinct countries and states."""
    return classified.agg(
        F.count_distinct("country").alias("countries"), F.count_distinct("state").alias("us_states")
    )


def observe_rows(df: DataFrame, stage: str) -> tuple[DataFrame, Observation]:
    """Count rows passing a stage as a side effect of the job that reads them."""
    observation = Observation(stage)
    return df.observe(observation, F.count("*").alias("rows")), observation


def funnel(
    raw: DataFrame, unique: DataFrame, types: str | Iterable[str] | None = DEFAULT_TYPES, file: str | None = None
) -> DataFrame:
    """Rows per stage as a table: read, after type filter, after dedup, geolocated, without GPS; files used, by column ``file``."""
    rows = F.count("*")
    wanted = type_set(types)
    kept = F.lit(True) if wanted is None else normalize_type(F.col(TYPE)).isin(wanted)
    measures = [rows.alias("rows_read"), F.count_if(kept).alias("after_type_filter")]
    if file:
        raw = raw.groupBy(file).agg(*measures)
        measures = [F.sum(name).cast("long").alias(name) for name in ("rows_read", "after_type_filter")]
        measures.append(rows.alias("files_used"))
    read = raw.agg(*measures)
    deduped = unique.agg(
        rows.alias("after_dedup"),
        F.count_if(has_position()).alias("geolocated"),
        F.count_if(~has_position()).alias("no_gps"),
    )
    return read.unpivot([], read.columns, "stage", "n").unionByName(
        deduped.unpivot([], deduped.columns, "stage", "n")
    )
