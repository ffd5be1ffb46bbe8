"""Calendar spines and gap filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def day_spine(bounds: DataFrame, by: Sequence[str] = (), day: str = "date") -> DataFrame:
    """One row per day from ``lo`` to ``hi`` (inclusive) for every row of ``bounds``."""
    days = F.explode(F.sequence("lo", "hi", F.expr("interval 1 day")))
    return bounds.where(F.col("lo").isNotNull()).select(*by, days.alias(day))


def observed_bounds(df: DataFrame, day: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.min(day).alias("lo"), F.max(day).alias("hi"))


def fill_days(daily: DataFrame, measures: Sequence[str], day: str = "date", by: Sequence[str] = ()) -> DataFrame:
    """Dense daily rows between each series' first and last day; missing measures become 0."""
    spine = day_spine(observed_bounds(daily, day, by), by, day)
    zero_filled = [F.coalesce(F.col(m), F.lit(0).cast(daily.schema[m].dataType)).alias(m) for m in measures]
    return spine.join(daily, [*by, day], "left").select(*by, day, *zero_filled)


def fill_forward_then_back(rates: DataFrame, start: Column, end: Column, key: str = "currency_code",
                           day: str = "date", value: str = "rate_to_eur") -> DataFrame:
    """Full calendar per key; gaps take the last earlier value, leading gaps the first later one.

    The spine is exploded per key instead of crossing keys with days, and each
    window partition holds one key's calendar only.
    """
    keys = rates.select(key).distinct().select(key, start.alias("lo"), end.alias("hi"))
    dense = day_spine(keys, [key], day).join(rates, [key, day], "left")
    w = Window.partitionBy(key).orderBy(day)
    back = F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ahead = F.first(value, ignorenulls=True).over(w.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    return dense.select(day, key, F.coalesce(back, ahead).alias(value))
