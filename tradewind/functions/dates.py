"""Date parsing and calendar expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted layouts, tried in this order. One-letter parts take one or two digits.
MIXED_DATE_LAYOUTS = ("yyyy-M-d", "d/M/yyyy", "d-M-yyyy")
# Each layout in full width, and where its year, month and day start. A text fits one of them at most.
_FULL_WIDTH = {
    "yyyy-M-d": (r"\A[1-9]\d{3}-\d\d-\d\d\z", (1, 6, 9)),
    "d/M/yyyy": (r"\A\d\d/\d\d/[1-9]\d{3}\z", (7, 4, 1)),
    "d-M-yyyy": (r"\A\d\d-\d\d-[1-9]\d{3}\z", (7, 4, 1)),
}


def _full_width_date(c: Column, layout: str) -> Column:
    """The date of a text in full width, by a cast, which takes a third of the time of trying the layouts."""
    pattern, (year, month, day) = _FULL_WIDTH[layout]
    iso = c if year == 1 else F.concat_ws("-", F.substring(c, year, 4), F.substring(c, month, 2), F.substring(c, day, 2))
    return F.when(c.rlike(pattern), iso.try_cast("date"))


def _parsed(c: Column, layouts: Sequence[str]) -> Column:
    return F.coalesce(*[_full_width_date(c, x) for x in layouts if x in _FULL_WIDTH], *[F.try_to_date(c, x) for x in layouts])


def lenient_date(c: Column, layout: str = "yyyy-M-d") -> Column:
    """Parse text to a date; anything that does not parse becomes null."""
    return _parsed(c, (layout,))


def mixed_date(c: Column) -> Column:
    """First layout of MIXED_DATE_LAYOUTS that parses wins, else null."""
    return _parsed(c, MIXED_DATE_LAYOUTS)


def strict_date(c: Column) -> Column:
    """Parse ISO text to a date and fail the job on bad input."""
    return c.cast("date")


def has_slash(c: Column) -> Column:
    return c.contains("/")


def dashed_not_iso(c: Column) -> Column:
    return c.contains("-") & ~c.rlike(r"^\d{4}-")


def month_start(c: Column) -> Column:
    return F.trunc(c, "MM")


def period_start(c: Column, period: str) -> Column:
    """First day of the year, quarter or month."""
    return F.trunc(c, period)


def months_apart(later_month: Column, earlier_month: Column) -> Column:
    """Whole months between two month starts (counts month boundaries)."""
    return F.months_between(later_month, earlier_month).cast("long")
