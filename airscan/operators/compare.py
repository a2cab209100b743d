"""Channel distribution of two scans, side by side.

Both scans run through one tagged table: one dedup shuffle on (side, MAC), then
aggregates of a few hundred rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airscan.functions.channels import UNKNOWN, channel_band, channel_unii, short_unii
from airscan.functions.numbers import round_half_even
from airscan.operators.dedup import strongest_wifi
from airscan.operators.normalize import coerce_numbers, wifi_only, with_channel
from airscan.schema import MAC, RSSI

BAND_DIGITS = 1
CHANNEL_DIGITS = 2


def tag_sides(scan_a: DataFrame, scan_b: DataFrame) -> DataFrame:
    """Both scans as one table with a ``side`` column."""
    return scan_a.withColumn("side", F.lit("A")).unionByName(
        scan_b.withColumn("side", F.lit("B")), allowMissingColumns=True
    )


def prepare(df: DataFrame, by: Sequence[str] = (), ties: Sequence[Column | str] | None = None) -> DataFrame:
    """WiFi rows, strongest per device (per side, with ``by``), with channel, band and UNII label."""
    wifi = wifi_only(df)
    if RSSI in wifi.columns:
        wifi = coerce_numbers(wifi, [RSSI])
    channel = F.col("channel_int")
    return with_channel(strongest_wifi(wifi, (*by, MAC), ties)).withColumns(
        {"band": channel_band(channel), "unii": channel_unii(channel)}
    )


def with_share(counts: DataFrame, by: Sequence[str], digits: int) -> DataFrame:
    """Add ``pct``, the share of ``count`` in the total of its ``by`` group.

    One total, or one per side, is broadcast; for any other grouping Spark chooses the
    join.  The counts are never gathered into one task.
    """
    if not by:
        return with_share(counts.withColumn("_all", F.lit(0)), ["_all"], digits).drop("_all")
    totals = counts.groupBy(*by).agg(F.sum("count").alias("_total"))
    if list(by) in (["side"], ["_all"]):
        totals = F.broadcast(totals)
    pct = round_half_even(F.col("count") / F.col("_total") * 100, digits)
    return counts.join(totals, list(by)).withColumn("pct", pct).select(*counts.columns, "pct")


def band_table(prepared: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows and share per band, unknown included."""
    counts = prepared.groupBy(*by, "band").agg(F.count("*").alias("count"))
    return with_share(counts, by, BAND_DIGITS)


def channel_table(prepared: DataFrame, by: Sequence[str] = (), include_ungrouped: bool = False) -> DataFrame:
    """Rows and share per channel of the known bands.

    By default only channels with a UNII label are counted, so 2.4 GHz and off-grid
    channels are absent and shares refer to the rest; ``include_ungrouped`` keeps them.
    """
    valid = prepared.filter(F.col("band") != UNKNOWN)
    if not include_ungrouped:
        valid = valid.filter(F.col("unii").isNotNull())
    counts = valid.groupBy(*by, "channel_int", "band", "unii").agg(F.count("*").alias("count"))
    return with_share(counts, by, CHANNEL_DIGITS)


def _with_delta(merged: DataFrame, label_a: str, label_b: str, digits: int) -> DataFrame:
    values = [f"{label}_{measure}" for label in (label_a, label_b) for measure in ("count", "pct")]
    delta = round_half_even(F.col(f"`{label_b}_pct`") - F.col(f"`{label_a}_pct`"), digits)
    return merged.fillna(0, values).withColumn("pct_delta", delta).withColumn("flag", divergence(F.col("pct_delta")))


def divergence(delta: Column, least: float = 1.0) -> Column:
    """``B_higher`` or ``A_higher`` where the shares differ by at least one point, else null."""
    return F.when(F.abs(delta) >= least, F.when(delta > 0, "B_higher").otherwise("A_higher"))


def merge_sides(
    table: DataFrame, keys: Sequence[str], digits: int, label_a: str = "Scan_A", label_b: str = "Scan_B"
) -> DataFrame:
    """Rows of a per-side table next to each other; a key missing on one side counts 0 there.

    Same result as a full outer join of the two sides, without computing the table twice.
    """
    sides = (("A", label_a), ("B", label_b))
    values = [
        F.max(F.when(F.col("side") == side, F.col(measure))).alias(f"{label}_{measure}")
        for side, label in sides
        for measure in ("count", "pct")
    ]
    return _with_delta(table.groupBy(*keys).agg(*values), label_a, label_b, digits)


def merge_tables(
    table_a: DataFrame,
    table_b: DataFrame,
    keys: Sequence[str],
    digits: int,
    label_a: str = "Scan_A",
    label_b: str = "Scan_B",
) -> DataFrame:
    """Full outer join of two finished tables, for example read back from earlier reports."""

    def labelled(table: DataFrame, label: str) -> DataFrame:
        return table.withColumnsRenamed({"count": f"{label}_count", "pct": f"{label}_pct"})

    a, b = labelled(table_a, label_a), labelled(table_b, label_b)
    merged = a.join(b.withColumnRenamed("unii", "_unii"), list(keys), "full_outer")
    if "unii" in a.columns:
        merged = merged.withColumn("unii", F.coalesce("unii", "_unii")).drop("_unii")
    return _with_delta(merged, label_a, label_b, digits)


def compare_bands(sides: DataFrame, label_a: str = "Scan_A", label_b: str = "Scan_B") -> DataFrame:
    """Band table of both scans of a prepared, tagged table, with the share difference."""
    return merge_sides(band_table(sides, ["side"]), ["band"], BAND_DIGITS, label_a, label_b)


def compare_channels(
    sides: DataFrame, label_a: str = "Scan_A", label_b: str = "Scan_B", include_ungrouped: bool = False
) -> DataFrame:
    """Channel table of both scans of a prepared, tagged table, with the share difference."""
    table = channel_table(sides, ["side"], include_ungrouped)
    return merge_sides(table, ["channel_int", "band", "unii"], CHANNEL_DIGITS, label_a, label_b)


def most_divergent(channels: DataFrame, n: int = 20) -> DataFrame:
    """Channels whose shares differ most."""
    return channels.orderBy(F.desc(F.abs("pct_delta")), "band", "channel_int").limit(n)


def display_bands(merged: DataFrame, label_a: str = "Scan_A", label_b: str = "Scan_B") -> DataFrame:
    """Band comparison as text: thousands separators, percent signs, signed differences."""
    return merged.select("band", *_display(label_a, label_b, BAND_DIGITS)).orderBy("band")


def display_channels(merged: DataFrame, label_a: str = "Scan_A", label_b: str = "Scan_B") -> DataFrame:
    """Channel comparison as text, with the short UNII label and a mark where a side is at least 1 point higher."""
    mark = F.when(F.col("flag") == "B_higher", "◄").when(F.col("flag") == "A_higher", "▼").otherwise("")
    unii = short_unii(F.col("unii"), F.col("band"))
    ordered = merged.orderBy("band", "channel_int")
    columns = _display(label_a, label_b, CHANNEL_DIGITS)
    return ordered.select(F.col("channel_int").cast("int").alias("ch"), "band", unii.alias("unii"), *columns, mark.alias("mark"))


def _display(label_a: str, label_b: str, digits: int) -> list[Column]:
    columns = []
    for label in (label_a, label_b):
        columns.append(F.format_number(f"`{label}_count`", 0).alias(f"{label}_count"))
        columns.append(F.format_string(f"%.{digits}f%%", F.col(f"`{label}_pct`")).alias(f"{label}_pct"))
    columns.append(F.format_string(f"%+.{digits}f", F.col("pct_delta")).alias("pct_delta"))
    return columns
