"""Text normalisation and SSID measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# The characters a text strip removes; ``trim`` alone removes only spaces.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def normalize_type(radio_type: Column) -> Column:
    """Upper case, all surrounding whitespace removed."""
    return F.upper(F.btrim(radio_type, F.lit(WHITESPACE)))


def normalize_ssid(ssid: Column) -> Column:
    """Lower case, runs of whitespace as one space, ends stripped."""
    return F.trim(F.regexp_replace(F.lower(ssid), r"\s+", " "))


def char_entropy(text: Column) -> Column:
    """Shannon entropy of the characters in bits; null for null, 0 for empty text."""
    length = F.length(text)

    def add(total: Column, char: Column) -> Column:
        share = (length - F.length(F.replace(text, char, F.lit("")))) / length
        return total - share * F.log2(share)

    distinct = F.array_distinct(F.split(text, ""))
    return F.when(length > 0, F.aggregate(distinct, F.lit(0.0), add)).when(length == 0, F.lit(0.0))


# Prefix and trailing number of a numbered name, e.g. "Free Net 12"; numbers may have any length.
NUMBERED = r"^(.*?)(\d+)\s*$"
LOW_DIGITS = 18
LOW_BLOCKS = 10**LOW_DIGITS // 64  # blocks of 64 numbers that share their digits before the last 18


def is_numbered(ssid: Column) -> Column:
    """Does a name end in a number?"""
    return ssid.rlike(NUMBERED)


def number_prefix(ssid: Column) -> Column:
    """Normalised text before the trailing number of a numbered name."""
    return normalize_ssid(F.regexp_extract(ssid, NUMBERED, 1))


def trailing_digits(ssid: Column) -> Column:
    """Digits of the trailing number without leading zeros."""
    return F.regexp_replace(F.regexp_extract(ssid, NUMBERED, 2), r"^0+(?=\d)", "")


def number_block(digits: Column) -> tuple[Column, Column, Column]:
    """A number's digits before the last 18 (0 if none) as text, its block of 64 within these, and its place in the block."""
    cut = F.length(digits) - LOW_DIGITS
    high = F.when(cut > 0, F.substring(digits, F.lit(1), cut)).otherwise(F.lit("0"))
    low = F.right(digits, F.lit(LOW_DIGITS)).cast("long")
    place = F.pmod(low, F.lit(64))
    return high, F.call_function("div", low - place, F.lit(64)), place.cast("int")


def one_less(digits: Column) -> Column:
    """A number's digits less one, for numbers of any length above 0; null for 0."""
    body = F.regexp_replace(digits, "0+$", "")
    nines = F.repeat(F.lit("9"), F.length(digits) - F.length(body))
    last = (F.right(body, F.lit(1)).cast("int") - 1).cast("string")
    less = F.concat(F.substring(body, F.lit(1), F.length(body) - 1), last, nines)
    return F.when(F.length(body) > 0, F.regexp_replace(less, r"^0+(?=\d)", ""))


# Words that may be hexadecimal counters, and the lines of a numbered text: number, separator, rest.
HEX_WORD = "^[0-9a-f]{2,15}$"
LINE = r"^(\d{1,4})([ .:)_-]+)([^0-9 .:)_-].*)$"


def with_slots(text: Column, pattern: str) -> Column:
    """For each run of a pattern, the run and the text with ``{}`` in its place: an array of (run, skeleton)."""
    runs, between = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)), F.split(text, pattern)

    def slot(run: Column, at: Column) -> Column:
        def piece(part: Column, i: Column) -> Column:
            own = F.when(i == at, F.lit("{}")).otherwise(F.coalesce(F.get(runs, i), F.lit("")))
            return F.concat(part, own)

        return F.struct(run.alias("run"), F.array_join(F.transform(between, piece), "").alias("skeleton"))

    return F.transform(runs, slot)
