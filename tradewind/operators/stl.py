"""Seasonal-trend decomposition by LOESS, one daily series per task.

Follows Cleveland, Cleveland, McRae and Terpenning, "STL: A Seasonal-Trend
Decomposition Procedure Based on Loess" (1990). Spark aggregates the facts to
one row per day and series before anything reaches Python, so a group holds at
most one calendar.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Executors need not have the package installed: these functions travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Z_LIMIT = 3.5
PERIOD = 7
SEASONAL_SPAN = 7
INNER, OUTER = 2, 15


def _odd_above(x: float) -> int:
    n = int(np.ceil(x))
    return n if n % 2 else n + 1


def _loess(y: np.ndarray, span: int, robust: np.ndarray, pad: int = 0) -> np.ndarray:
    """Local linear fit at positions ``1 - pad .. n + pad`` from the ``span`` nearest points."""
    n = len(y)
    width = min(span, n)
    at = np.arange(1 - pad, n + pad + 1, dtype=float)
    left = np.clip(at.astype(int) - (span + 1) // 2, 0, n - width)
    idx = left[:, None] + np.arange(width)[None, :]
    x = idx + 1.0
    dist = np.abs(x - at[:, None])
    reach = dist.max(axis=1, keepdims=True) + max(span - n, 0) // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        near = (1.0 - (dist / reach) ** 3) ** 3
    weight = np.where(dist <= 0.001 * reach, 1.0, np.where(dist <= 0.999 * reach, near, 0.0)) * robust[idx]
    total = weight.sum(axis=1, keepdims=True)
    usable = total[:, 0] > 0
    weight = weight / np.where(total > 0, total, 1.0)
    centre = (weight * x).sum(axis=1, keepdims=True)
    spread = (weight * (x - centre) ** 2).sum(axis=1, keepdims=True)
    slope_ok = np.sqrt(spread) > 0.001 * (n - 1)
    tilt = np.where(slope_ok, (at[:, None] - centre) / np.where(slope_ok, spread, 1.0), 0.0)
    fit = (weight * (1.0 + tilt * (x - centre)) * y[idx]).sum(axis=1)
    return np.where(usable, fit, y[np.clip(at.astype(int) - 1, 0, n - 1)])


def _moving_mean(x: np.ndarray, span: int) -> np.ndarray:
    run = np.cumsum(np.concatenate(([0.0], x)))
    return (run[span:] - run[:-span]) / span


def decompose(y: np.ndarray, period: int = PERIOD, seasonal: int = SEASONAL_SPAN,
              inner: int = INNER, outer: int = OUTER) -> tuple[np.ndarray, np.ndarray]:
    """(seasonal, trend) of a regular series with robust weights."""
    n = len(y)
    trend_span = _odd_above(1.5 * period / (1.0 - 1.5 / seasonal))
    low_span = _odd_above(period + 1)
    ones = np.ones(n)
    robust, trend, season = ones, np.zeros(n), np.zeros(n)
    for round_no in range(outer + 1):
        for _ in range(inner):
            free = y - trend
            cycle = np.empty(n + 2 * period)
            for phase in range(period):
                cycle[phase::period] = _loess(free[phase::period], seasonal, robust[phase::period], pad=1)
            smooth = _moving_mean(_moving_mean(_moving_mean(cycle, period), period), 3)
            season = cycle[period:period + n] - _loess(smooth, low_span, ones)
            trend = _loess(y - season, trend_span, robust)
        if round_no < outer:
            rest = np.abs(y - season - trend)
            limit = 6.0 * np.median(rest)
            with np.errstate(divide="ignore", invalid="ignore"):
                mid = (1.0 - (rest / limit) ** 2) ** 2
            robust = np.where(rest <= 0.001 * limit, 1.0, np.where(rest <= 0.999 * limit, mid, 0.0))
    return season, trend


def poisson_residuals(daily: DataFrame, count: str = "orders_count", day: str = "date",
                      by: Sequence[str] = ()) -> DataFrame:
    """Pearson residual of daily counts against trend + weekly season, flagged beyond 3.5.

    ``daily`` must be dense. ``expected`` never goes below one order. Series
    shorter than two periods get no score.
    """
    by = list(by)
    keys = by or ["_series"]
    source = daily if by else daily.withColumn("_series", F.lit(0))
    source = source.select(*keys, day, F.col(count).cast("double").alias("_y"))

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(day)
        y = pdf["_y"].to_numpy(dtype=float)
        if len(y) < 2 * PERIOD:
            expected = np.full(len(y), np.nan)
        else:
            season, trend = decompose(y)
            expected = np.maximum(season + trend, 1.0)
        z = (y - expected) / np.sqrt(expected)
        return pdf[[*keys, day]].assign(
            expected=expected, raw_z=z, poisson_z=np.round(z, 3),
            stl_poisson_anomaly=np.abs(np.nan_to_num(z)) > Z_LIMIT)

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.schema if f.name != "_y")
    scored = source.groupBy(*keys).applyInPandas(
        score, f"{types}, expected double, raw_z double, poisson_z double, stl_poisson_anomaly boolean")
    scored = scored.select(*by, day, *[
        F.when(~F.isnan(c), F.col(c)).alias(c) for c in ("expected", "raw_z", "poisson_z")], "stl_poisson_anomaly")
    return daily.join(scored, [*by, day])
