"""Ratios and rounding as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column, den: Column) -> Column:
    """num / den in doubles; null when the denominator is zero or null."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def round_to(c: Column, places: int) -> Column:
    """Round a double by scaling, rounding to a whole number and scaling back.

    Works on the binary value (1.005 becomes 1.0), as SQL engines with native
    doubles do; Spark's ``round`` would first turn the double into its decimal text.
    """
    scale = float(10**places)
    return F.round(c.cast("double") * F.lit(scale)) / F.lit(scale)


def whole_part(x: Column) -> Column:
    """The whole part of a double that isn't negative, as a double: no value is too large for it."""
    return x - x % F.lit(1.0)


def round_half_up(x: Column, places: Column) -> Column:
    """A double that isn't negative, rounded half up to a number of places given per row."""
    unit = F.pow(F.lit(10.0), places)
    return whole_part(x * unit + F.lit(0.5)) / unit


def round_as_printed(c: Column, places: int) -> Column:
    """Round a double the way correctly rounding printf does: exact ties go to even.

    ``hi + lo`` is the exact product ``c * 10**places``: ``c`` is split into two
    halves short enough for both partial products to be exact, so a value that
    only looks like a tie in decimal (51.45) is still rounded by its true size.
    """
    x = F.abs(c.cast("double"))
    scale = F.lit(float(10**places))
    wide = x * F.lit(134217729.0)  # 2**27 + 1
    head = wide - (wide - x)
    tail = x - head
    hi = x * scale
    lo = (head * scale - hi) + tail * scale
    whole = whole_part(hi)
    over = (hi - whole) - F.lit(0.5)
    odd = (whole % F.lit(2.0)) == 1.0
    up = (over > 0) | ((over == 0) & ((lo > 0) | ((lo == 0) & odd)))
    units = F.when(up, whole + 1).otherwise(whole)
    return F.when(c < 0, -units).otherwise(units) / scale


def grouped_number(c: Column, places: int, sign: bool = False) -> Column:
    """Text with thousands separators and ``places`` decimals, optionally always signed."""
    flag = "+" if sign else ""
    return F.format_string(f"%{flag},.{places}f", round_as_printed(c, places))


def plain_number(c: Column, places: int, sign: bool = False) -> Column:
    """Text with ``places`` decimals and no separators."""
    flag = "+" if sign else ""
    return F.format_string(f"%{flag}.{places}f", round_as_printed(c, places))
