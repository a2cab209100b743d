"""The comparison job: two scans to band and channel tables with share differences."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airscan.operators.compare import compare_bands, compare_channels, prepare, tag_sides
from airscan.sources.sinks import write_comparison
from airscan.sources.survey_csv import read_logs


class Comparison(NamedTuple):
    """Both tables; from paths also what was not used of the logs, by scan label."""

    bands: DataFrame
    channels: DataFrame
    rejected_files: DataFrame | None = None
    rejected_rows: DataFrame | None = None


def compare_scans(
    scan_a: DataFrame,
    scan_b: DataFrame,
    label_a: str = "Scan_A",
    label_b: str = "Scan_B",
    include_ungrouped: bool = False,
    ties=None,
) -> Comparison:
    """Compare two tables of sightings."""
    sides = prepare(tag_sides(scan_a, scan_b), ["side"], ties)
    return Comparison(
        compare_bands(sides, label_a, label_b),
        compare_channels(sides, label_a, label_b, include_ungrouped),
    )


def compare_paths(
    spark: SparkSession,
    a: str,
    b: str,
    label_a: str = "Scan_A",
    label_b: str = "Scan_B",
    out: str | None = None,
    include_ungrouped: bool = False,
    **reading,
) -> Comparison:
    """Compare two logs or folders of logs; ``out`` also writes the two tables there.

    ``reading`` are options of :func:`airscan.sources.survey_csv.read_logs`.
    """
    first, second = (read_logs(spark, path, **reading) for path in (a, b))
    result = compare_scans(first.rows, second.rows, label_a, label_b, include_ungrouped)
    if out:
        write_comparison(result.bands, result.channels, out)

    def both(one: DataFrame, other: DataFrame) -> DataFrame:
        return one.withColumn("scan", F.lit(label_a)).unionByName(other.withColumn("scan", F.lit(label_b)))

    return result._replace(
        rejected_files=both(first.rejected_files, second.rejected_files),
        rejected_rows=both(first.rejected_rows, second.rejected_rows),
    )
