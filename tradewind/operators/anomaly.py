"""Daily-series outlier detectors built from window functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions.numbers import ratio

HISTORY = 8  # same weekdays looked back on
MIN_HISTORY = 4  # fewer than this give no baseline
Z_LIMIT = 2.5
FENCE = 1.5


def iqr_fence(daily: DataFrame, value: str = "net_revenue_eur", by: Sequence[str] = (),
              out: str = "iqr_anomaly") -> DataFrame:
    """Flag values outside [Q1 - 1.5 IQR, Q3 + 1.5 IQR] of their whole series.

    A series has one row per calendar day, so the window partition and the
    quantile's value map are bounded by the calendar, whatever the fact size.
    """
    series = Window.partitionBy(*(by or [F.lit(0)]))
    x = F.col(value).cast("double")
    q = F.percentile(x, F.array(F.lit(0.25), F.lit(0.75))).over(series)
    fenced = daily.withColumn("_q", q)
    q1, q3 = F.col("_q")[0], F.col("_q")[1]
    reach = (q3 - q1) * F.lit(FENCE)
    return (fenced.withColumn("q1", q1).withColumn("q3", q3)
            .withColumn(out, ~x.between(q1 - reach, q3 + reach)).drop("_q"))


def weekday_baseline(daily: DataFrame, value: str = "net_revenue_eur", day: str = "date",
                     by: Sequence[str] = ()) -> DataFrame:
    """Compare each day with the eight preceding same weekdays of a dense daily series.

    Baseline is their median, spread their sample standard deviation (none
    below four days, no score when it is zero). Causal: a day is judged by its
    past only. A window partition is one weekday of one series.
    """
    x = F.col(value).cast("double")
    past = Window.partitionBy(*by, "dow").orderBy(day).rowsBetween(-HISTORY, -1)
    enough = F.count(x).over(past) >= MIN_HISTORY
    scored = (
        daily.withColumn("dow", F.weekday(day).cast("long"))
        .withColumn("seasonal_baseline", F.when(enough, F.percentile(x, F.lit(0.5)).over(past)))
        .withColumn("_spread", F.when(enough, F.stddev_samp(x).over(past)))
        .withColumn("residual", x - F.col("seasonal_baseline"))
        .withColumn("seasonal_zscore", ratio(F.col("residual"), F.col("_spread")))
    )
    flagged = F.coalesce(F.abs("seasonal_zscore") > Z_LIMIT, F.lit(False))
    return (scored.withColumn("zscore_anomaly", flagged).withColumn("is_anomaly", flagged)
            .withColumn("direction", F.when(F.coalesce("residual", F.lit(0.0)) >= 0, "spike").otherwise("drop"))
            .drop("_spread"))


def group_zscore(df: DataFrame, value: str, group: str, out: str) -> DataFrame:
    """Population z-score within a group; nulls are skipped, a constant group gives null.

    For marts whose groups are bounded by dimension sizes.
    """
    w = Window.partitionBy(group)
    x = F.col(value).cast("double")
    return df.withColumn(out, ratio(x - F.avg(x).over(w), F.stddev_pop(x).over(w)))
