"""Seed tables and other fixed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.sources.schemas import COUNTRY_COLUMNS, COUNTRY_SEED


def fixed_rows(spark: SparkSession, rows: Sequence[Sequence[str]], columns: Sequence[str]) -> DataFrame:
    """A few literal rows inside the plan; Catalyst knows their size and broadcasts them unasked."""
    cells = [F.struct(*[F.lit(v).alias(c) for c, v in zip(columns, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*cells)))


def country_seed(spark: SparkSession) -> DataFrame:
    """The seven-country seed."""
    return fixed_rows(spark, COUNTRY_SEED, COUNTRY_COLUMNS)
