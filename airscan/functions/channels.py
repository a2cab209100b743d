"""WiFi channel plan: band, group, UNII label and centre frequency of a channel number.

All functions take the channel as a double and judge it by its integer part
(truncated toward zero), so 6.7 counts as channel 6.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

BAND_24 = "2.4GHz"
BAND_5 = "5GHz"
UNKNOWN = "unknown"

# First channel, last channel, step, group label, UNII label.
UNII_GROUPS = (
    (36, 48, 4, "5GHz_UNII1_36-48", "UNII-1 (36-48, no DFS)"),
    (52, 96, 4, "5GHz_UNII2_52-96", "UNII-2A/2C (52-96, DFS)"),
    (100, 148, 4, "5GHz_UNII3_100-148", "UNII-3 (100-148, DFS)"),
    (149, 177, 4, "5GHz_UNII4_149-177", "UNII-4 (149-177, no DFS)"),
)

# Centre frequency in MHz; channels 1-13 are 5 MHz apart.
MHZ_CHANNEL_1 = 2412
MHZ_CHANNEL_14 = 2484


def whole_channel(channel: Column) -> Column:
    """Integer part of a channel; null beyond the integer range."""
    return channel.try_cast("int")


def _in_24(channel: Column) -> Column:
    return (channel >= 1) & (channel < 15)


def _in_5(channel: Column) -> Column:
    return (channel >= 36) & (channel < 178)


def channel_band(channel: Column) -> Column:
    """``2.4GHz`` for 1-14, ``5GHz`` for 36-177, else ``unknown`` (also for null)."""
    return F.when(_in_24(channel), BAND_24).when(_in_5(channel), BAND_5).otherwise(UNKNOWN)


def _unii(channel: Column, label: int) -> list[tuple[Column, str]]:
    number = whole_channel(channel)
    return [
        (number.between(group[0], group[1]) & ((number - group[0]) % group[2] == 0), group[label])
        for group in UNII_GROUPS
    ]


def channel_group(channel: Column, strict: bool = False) -> Column:
    """Group label: per channel in 2.4 GHz, per UNII group in 5 GHz, ``5GHz_ch{n}`` for any other number.

    The last case also catches numbers outside both bands (-1, 0, 15-35, 178 and up);
    ``strict`` calls those ``unknown``, as :func:`channel_band` does.
    """
    number = F.when(channel < 0, F.ceil(channel)).otherwise(F.floor(channel)).cast("string")
    rest = F.concat(F.lit("5GHz_ch"), number)
    if strict:
        rest = F.when(_in_5(channel), rest).otherwise(UNKNOWN)
    labels = [(_in_24(channel), F.concat(F.lit("2.4GHz_ch"), number))]
    labels += [(test, F.lit(label)) for test, label in _unii(channel, 3)]
    start = F.when(channel.isNull(), F.lit(UNKNOWN))
    return reduce(lambda chain, case: chain.when(*case), labels, start).otherwise(rest)


def channel_unii(channel: Column) -> Column:
    """UNII label of an on-grid 5 GHz channel, else null."""
    first, *others = _unii(channel, 4)
    return reduce(lambda chain, case: chain.when(*case), others, F.when(*first))


def short_unii(unii: Column, band: Column) -> Column:
    """Label text before the bracket, for 5 GHz only."""
    return F.when((band == BAND_5) & unii.isNotNull(), F.substring_index(unii, " (", 1)).otherwise("")


def channel_mhz(channel: Column) -> Column:
    """Centre frequency of a 2.4 GHz channel, else null."""
    number = whole_channel(channel)
    return F.when(number.between(1, 13), MHZ_CHANNEL_1 + 5 * (number - 1)).when(
        number == 14, F.lit(MHZ_CHANNEL_14)
    )
