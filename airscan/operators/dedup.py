"""Strongest sighting per device.

``row_number() = 1`` lets Spark keep only each task's best row per key before the
shuffle (``WindowGroupLimit``), so a key holding a third of all rows still sends at
most one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airscan.operators.normalize import with_column_or_null
from airscan.schema import FILE, MAC, RSSI, SEEN, TYPE


def tie_order(df: DataFrame, first: Sequence[str] = (SEEN, FILE)) -> list[Column]:
    """A total order over row content, so equal signal strengths resolve the same way on every run."""
    sortable = [name for name, kind in df.dtypes if not kind.startswith("map")]
    leading = [name for name in first if name in sortable]
    return [F.col(f"`{name}`").asc_nulls_last() for name in leading + [n for n in sortable if n not in leading]]


def strongest(
    df: DataFrame, keys: Sequence[str] = (MAC, TYPE), ties: Sequence[Column | str] | None = None
) -> DataFrame:
    """One row per key: the highest ``RSSI``, missing strengths last.  Null keys count as equal."""
    order = [F.col(RSSI).desc_nulls_last(), *(tie_order(df) if ties is None else ties)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def strongest_wifi(
    df: DataFrame, keys: Sequence[str] = (MAC,), ties: Sequence[Column | str] | None = None
) -> DataFrame:
    """One row per WiFi device; without an ``RSSI`` column the first row in file order is kept."""
    if RSSI in df.columns:
        return strongest(df, keys, ties)
    ties = tie_order(df, (FILE,)) if ties is None else ties
    return strongest(with_column_or_null(df, RSSI, "double"), keys, ties).drop(RSSI)
