"""Projections and predicates over raw observations."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airscan.functions.numbers import finite, to_number
from airscan.functions.text import normalize_type
from airscan.schema import AUTH, CHANNEL, DEFAULT_TYPES, LAT, LON, RSSI, SEEN, TYPE


def type_set(types: str | Iterable[str] | None) -> list[str] | None:
    """A comma-separated text or a list of radio types, stripped and upper-cased; ``None`` keeps all."""
    if types is None:
        return None
    items = types.split(",") if isinstance(types, str) else types
    return sorted({item.strip().upper() for item in items})


def keep_types(df: DataFrame, types: str | Iterable[str] | None = DEFAULT_TYPES) -> DataFrame:
    """Normalise ``Type`` and keep the listed radio types; a missing type is never selected by a list."""
    df = df.withColumn(TYPE, normalize_type(F.col(TYPE)))
    wanted = type_set(types)
    return df if wanted is None else df.filter(F.col(TYPE).isin(wanted))


def wifi_only(df: DataFrame) -> DataFrame:
    return keep_types(df, ["WIFI"])


def with_column_or_null(df: DataFrame, name: str, dtype: str = "string") -> DataFrame:
    """Add a null column where a source lacks an optional one."""
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(dtype))


def numeric(df: DataFrame, name: str) -> Column:
    """A column as finite double, parsed leniently if it is text."""
    column = F.col(name)
    return to_number(column) if dict(df.dtypes)[name] == "string" else finite(column.cast("double"))


def coerce_numbers(df: DataFrame, names: Iterable[str] = (RSSI, LAT, LON)) -> DataFrame:
    """Replace columns by their numeric reading; failures and absent columns become null."""
    names = list(names)
    for name in names:
        df = with_column_or_null(df, name)
    return df.withColumns({name: numeric(df, name) for name in names})


def with_channel(df: DataFrame, out: str = "channel_int") -> DataFrame:
    """Add the numeric channel; null where ``Channel`` is absent or not a number."""
    df = with_column_or_null(df, CHANNEL)
    return df.withColumn(out, numeric(df, CHANNEL))


def has_position() -> Column:
    return F.col(LAT).isNotNull() & F.col(LON).isNotNull()


def geolocated(df: DataFrame) -> DataFrame:
    """Rows with both coordinates."""
    return df.filter(has_position())


def no_gps(df: DataFrame) -> DataFrame:
    """Exact complement of :func:`geolocated`."""
    return df.filter(~has_position())


def is_open(auth: str = AUTH, pattern: str = "[OPEN]") -> Column:
    """Open-network predicate; a missing mode is not open."""
    return F.coalesce(F.col(auth).contains(pattern), F.lit(False))


def with_seen(df: DataFrame, seen: str = SEEN) -> DataFrame:
    """Add ``ts``, the sighting time as a timestamp; unreadable times become null."""
    return df.withColumn("ts", F.col(seen).try_cast("timestamp"))
