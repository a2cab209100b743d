"""Partitioned tables and log-compatible text exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airscan.operators.normalize import no_gps, numeric
from airscan.operators.summaries import band_summary, channel_cube, channel_summary
from airscan.schema import LOG_PREHEADER, RSSI
from airscan.sources.local import added, bounded, staged

MAX_RECORDS_PER_FILE = 5_000_000
ROWS_PER_EXPORT = 1_000_000


def write_table(df: DataFrame, path: str) -> None:
    """Write as Parquet."""
    df.write.mode("overwrite").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).parquet(path)


def write_split(df: DataFrame, path: str, by: str) -> None:
    """Write one folder per value of ``by`` in a single pass.

    ``rebalance`` gathers small values into few files and splits a value that holds
    most of the rows over many tasks.
    """
    (
        df.hint("rebalance", by)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy(by)
        .parquet(path)
    )


def without_helpers(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Without the columns that jobs added; input columns stay, whatever their names."""
    return df.drop(*[name for name in added(df) if name not in keep])


def split_regions(df: DataFrame, path: str) -> None:
    """One folder per coarse region."""
    write_split(without_helpers(df, ["region"]), path, "region")


def split_countries(df: DataFrame, path: str) -> None:
    """One folder per country present, ``other`` included."""
    write_split(without_helpers(df, ["country"]), path, "country")


def split_states(usa: DataFrame, path: str) -> None:
    """One folder per state of the USA rows, ``us_other`` included."""
    write_split(without_helpers(usa, ["state"]), path, "state")


def write_master(df: DataFrame, path: str) -> None:
    """All deduplicated rows, with and without position."""
    write_table(without_helpers(df), path)


def write_no_gps(df: DataFrame, path: str) -> bool:
    """Rows without position; nothing is written if there are none."""
    rows = without_helpers(no_gps(df))
    if rows.isEmpty():  # ends at the first row
        return False
    write_table(rows, path)
    return True


def write_channel_summaries(classified: DataFrame, path: str) -> None:
    """Band and channel counts of all countries and states.

    The counts per country, state and channel are written first; both summaries are
    small regroupings of that table.
    """
    write_table(channel_cube(classified), f"{path}/counts")
    counts = classified.sparkSession.read.parquet(f"{path}/counts")
    for name, table, order in (
        ("bands", band_summary(counts), ["level", "region", F.desc("count"), "band"]),
        ("channels", channel_summary(counts), ["level", "region", "channel_int"]),
    ):
        writer = table.orderBy(*order).write.mode("overwrite").option("header", True)
        writer.partitionBy("level").csv(f"{path}/{name}")


# -- log-compatible text ------------------------------------------------------


def csv_line(df: DataFrame, names: Sequence[str]) -> Column:
    """A row as one CSV line; quotes are doubled, nulls are empty."""
    options = {
        "escape": '"',
        "emptyValue": "",
        "nullValue": "",
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }
    return F.to_csv(F.struct(*[F.col(f"`{name}`") for name in names]), options)


def export_parts(df: DataFrame, key: Column, rows_per_file: int) -> DataFrame:
    """Logs needed per value of the split key, as ``_key`` (null is a value), ``_parts``, and ``_logs_before``, the logs of the values
    ahead of it; a written table."""
    counts = df.groupBy(key.alias("_key")).agg(F.count("*").alias("n"))
    parts = counts.select("_key", F.ceil(F.col("n") / rows_per_file).cast("long").alias("_parts"))
    ahead = Window.orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)  # one row per folder
    return staged(parts.withColumn("_logs_before", F.coalesce(F.sum("_parts").over(ahead), F.lit(0).cast("long"))), "export-parts")


def export_logs(
    df: DataFrame, path: str, by: str | None = None, rows_per_file: int = ROWS_PER_EXPORT, preheader: str = LOG_PREHEADER,
    header: Sequence[str] | None = None, written: bool = False,
) -> None:
    """Write rows as ``.csv`` log files: metadata line, header line, data lines, strongest signal first.

    Each value of ``by`` becomes a folder of logs that are valid on their own and hold
    about ``rows_per_file`` rows; null has Spark's folder for null.  Rows are counted per value
    first, so a value with most of the rows, or one row repeated many times, is spread over many
    logs and tasks.  ``header`` gives other names for the columns.  Rows are dealt by their place in
    ``df``, which a repeated task may find changed behind a shuffle: they are written down first, unless
    ``written`` says that they come from a written table without one.
    """
    key = F.col(by).cast("string") if by else F.lit("all")
    out = by or "set"
    names = [name for name in without_helpers(df).columns if name != by]
    parts = export_parts(df, key, rows_per_file)
    folders = parts.select(F.col("_key").alias("_folder"), "_parts", "_logs_before")
    strength = numeric(df, RSSI) if RSSI in names else F.lit(None).cast("double")
    numbered = df.withColumns({"_key": key, "_number": F.monotonically_increasing_id()})
    data = numbered.join(bounded(folders), F.col("_key").eqNullSafe(F.col("_folder"))).select(
        "_key", F.pmod(F.xxhash64("_number"), F.col("_parts")).alias("part"), "_logs_before", F.lit(2).alias("_lead"),
        strength.alias("_strength"), "_number", csv_line(df, names).alias("_row"),
    )
    if not written:
        data = staged(data, "export-rows")
    # A row with line breaks inside quotes is several lines, kept in order.
    data = data.select("*", F.posexplode(F.split("_row", "\n")).alias("_line", "value")).drop("_row")
    title = ",".join(_quoted(name) for name in header or names)
    leads = F.array(
        F.struct(F.lit(0).alias("_lead"), F.lit(preheader).alias("value")),
        F.struct(F.lit(1).alias("_lead"), F.lit(title).alias("value")),
    )
    lead = (
        parts.select("_key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)).alias("part"), "_logs_before")
        .select("_key", "part", "_logs_before", F.inline(leads))
        .withColumns({"_strength": F.lit(None).cast("double"), "_number": F.lit(0).cast("long"), "_line": F.lit(0)})
    )
    logs = parts.agg(F.sum("_parts")).first()[0] or 1
    (
        data.unionByName(lead)
        .withColumnRenamed("_key", out)
        .repartitionById(logs, (F.col("_logs_before") + F.col("part")).cast("int"))  # by hash two logs may meet in one task's sort
        .drop("_logs_before")
        .sortWithinPartitions(out, "part", "_lead", F.col("_strength").desc_nulls_last(), "_number", "_line")
        .select(out, "part", "value")
        .write.mode("overwrite")
        .partitionBy(out, "part")
        .options(**AS_IS)
        .csv(path)
    )


# Lines are finished texts: the writer adds no quotes, escapes or trimming, only the file extension.
AS_IS = {
    "sep": "\u0000",
    "quote": "\u0000",
    "escape": "\u0000",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "extension": "csv",
}


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"' if set(name) & set(',"\n') else name


# -- comparison report --------------------------------------------------------


def write_comparison(bands: DataFrame, channels: DataFrame, path: str) -> None:
    """Band and channel comparison as two CSV tables."""
    for name, table, order in (("bands", bands, ["band"]), ("channels", channels, ["band", "channel_int"])):
        table.orderBy(*order).write.mode("overwrite").option("header", True).csv(f"{path}/{name}")
