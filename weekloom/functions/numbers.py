"""Numeric conversions; nothing here raises on bad input, it yields null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Decimal and exponent forms; type suffixes such as ``12d`` are no numbers.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$|^\s*[+-]?[iI][nN][fF]([iI][nN][iI][tT][yY])?\s*$"


def to_number(c: Column) -> Column:
    """Double, null where the text is not a number (NaN counts as missing)."""
    number = c.try_cast("double")
    return F.when(c.cast("string").rlike(NUMBER) & ~F.isnan(number), number)


def zero_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(0))


def weeks_to_days(c: Column) -> Column:
    return c * 7


def binarize(c: Column, threshold: float = 0.5) -> Column:
    """1 above the threshold, 0 otherwise, null stays null."""
    return F.when(c.isNotNull(), (c > threshold).cast("int"))


def parse_grouped_int(c: Column) -> Column:
    """``1,234`` to 1234; blank to 0."""
    digits = F.trim(F.replace(c, F.lit(","), F.lit("")))
    return F.coalesce(F.nullif(digits, F.lit("")).try_cast("bigint"), F.lit(0).cast("bigint"))


def fill(c: Column, value) -> Column:
    return F.coalesce(c, F.lit(value))
