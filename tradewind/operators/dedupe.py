"""Duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Column | str) -> DataFrame:
    """The first row per key in ``order``; null keys count as one key.

    Spark turns ``row_number() = 1`` into a group limit that also runs before
    the exchange, so each task sends at most one row per key: a key holding a
    third of the table never piles up in one place.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("_place", F.row_number().over(w)).where("_place = 1").drop("_place")


def distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row duplicates removed; the partial aggregate collapses copies before the exchange."""
    return df.distinct()
