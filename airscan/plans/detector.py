"""The detector job: logs to signals per log and time window, and a report; also per cluster of sightings."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from airscan.operators.clusters import by_cluster, cluster_signals
from airscan.operators.normalize import coerce_numbers, with_column_or_null, with_seen
from airscan.operators.signals import DEFAULTS, Thresholds, all_signals, report
from airscan.schema import AUTH, LAT, LOG, LON, MAC, SEEN, SSID
from airscan.sources.local import staged
from airscan.sources.survey_csv import read_logs


def sightings(raw: DataFrame, log: str = LOG, seen: str = SEEN) -> DataFrame:
    """The columns the detector reads, typed; duplicates stay."""
    for name in (SSID, AUTH, seen):
        raw = with_column_or_null(raw, name)
    return with_seen(coerce_numbers(raw, [LAT, LON]), seen).select(log, "ts", MAC, SSID, AUTH, LAT, LON)


class Detection(NamedTuple):
    """The report, and what was not used of the logs."""

    report: DataFrame
    rejected_files: DataFrame
    rejected_rows: DataFrame


def scan_logs(
    spark: SparkSession, path: str, phrases: DataFrame, limits: Thresholds = DEFAULTS, seen: str = SEEN,
    clusters: bool = False, **reading,
) -> Detection:
    """Report on all logs below a folder, per time window, and with ``clusters`` per cluster of sightings too.

    Sightings are written once as a narrow table, as the modules read them several
    times, and the signals are written before they are reported.  ``reading`` are options
    of :func:`airscan.sources.survey_csv.read_logs`.
    """
    logs = read_logs(spark, path, **reading)
    rows = staged(sightings(logs.rows, LOG, seen), "sightings")
    if clusters:
        found = staged(cluster_signals(rows, phrases, LOG, limits), "signals")
        reported = by_cluster(report(found, "where"), LOG).orderBy(LOG, "cluster", "window_start")
    else:
        found = staged(all_signals(rows, phrases, LOG, limits), "signals")
        reported = report(found, LOG).orderBy(LOG, "window_start")
    return Detection(reported, logs.rejected_files, logs.rejected_rows)
