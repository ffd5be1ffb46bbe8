"""Exchange-rate service payloads flattened to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_RATES = "rates map<string, map<string, double>>"


def flatten_rates(payloads: DataFrame, currencies: Sequence[str], body: str = "payload") -> DataFrame:
    """(date, currency_code, rate_to_eur) from JSON texts ``{"rates": {day: {ccy: rate}}}``.

    Two narrow explodes, no shuffle: payload texts are processed where they are read.
    """
    days = payloads.select(F.explode(F.from_json(F.col(body), _RATES)["rates"]).alias("date", "by_currency"))
    rows = days.select("date", F.explode("by_currency").alias("currency_code", "rate_to_eur"))
    return rows.where(F.col("currency_code").isin(*currencies) & F.col("rate_to_eur").isNotNull())


def require_rates(rates: DataFrame) -> DataFrame:
    """The rates, or a failed job when there is none at all.

    The guard is a one-row union branch: it keeps no row and raises when the
    count is zero, so an empty result fails as well.
    """
    count = rates.agg(F.count("*").alias("n"))
    none = F.raise_error(F.lit("the payload holds no rates")).cast("boolean")
    guard = count.where(F.when(F.col("n") == 0, none).otherwise(F.lit(False)))
    return rates.unionByName(guard.select(*[
        F.lit(None).cast(f.dataType).alias(f.name) for f in rates.schema]))
