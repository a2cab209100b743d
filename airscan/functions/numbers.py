"""Lenient number parsing and half-even rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FOREIGN_LETTERS = "[a-df-zA-DF-Z]"


def to_number(text: Column) -> Column:
    """Text to double; anything that is not a finite decimal number becomes null.

    Letters other than the exponent keep out spellings only Spark accepts (``1d``, hex);
    NaN must not survive, as it sorts above every number.
    """
    text = text.cast("string")
    number = text.try_cast("double")
    return F.when((F.abs(number) < F.lit(float("inf"))) & ~text.rlike(FOREIGN_LETTERS), number)


def finite(number: Column) -> Column:
    """Null out NaN and infinities of a double column."""
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def round_half_even(value: Column, digits: int) -> Column:
    """Round the scaled double half to even; ``round`` and ``bround`` work on decimals and differ."""
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale
