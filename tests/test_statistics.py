import math
import random
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tradewind.operators import rfm, stl
from tradewind.operators.anomaly import group_zscore, iqr_fence, weekday_baseline
from tradewind.operators import quantiles
from tradewind.operators.quantiles import exact_quantiles, right_closed_bin
from tradewind.operators.ranking import global_row_number
from tradewind.operators.scoring import incident_days, score_detectors, sweep_thresholds

DAY0 = date(2024, 1, 1)


def series(spark, values, counts=None):
    rows = [(DAY0 + timedelta(days=i), float(v), int(c)) for i, (v, c) in enumerate(zip(values, [1] * len(values) if counts is None else counts))]
    return spark.createDataFrame(rows, "date date, net_revenue_eur double, orders_count long")


def test_quantiles_equal_numpy_on_hot_and_spread_values(spark):
    rng = random.Random(3)
    values = [7.25] * 400 + [round(rng.lognormvariate(4, 2), 2) for _ in range(700)] + [-rng.random() * 50 for _ in range(60)] + [0.0]
    groups = ["hot" if i % 3 == 0 else f"g{i % 5}" for i in range(len(values))]
    probs = [0.0, 0.2, 0.25, 0.5, 0.75, 0.8, 1.0]
    df = spark.createDataFrame(list(zip(groups, values)) + [("hot", None)], "g string, v double")
    total, = exact_quantiles(df, "v", probs).collect()
    assert total.n == len(values) and total.is_total
    np.testing.assert_allclose(total.q, np.quantile(values, probs), rtol=1e-12)
    for row in exact_quantiles(df, "v", probs, "g").where("not is_total").collect():
        mine = [v for g, v in zip(groups, values) if g == row.group]
        assert row.n == len(mine)
        np.testing.assert_allclose(row.q, np.quantile(mine, probs), rtol=1e-12)


def test_single_value(spark):
    row, = exact_quantiles(spark.createDataFrame([(4.0,)], "v double"), "v", [0.25, 0.5]).collect()
    assert row.q == [4.0, 4.0]


def test_bins_are_closed_on_the_right(spark):
    edges = [1 + 10 * p for p in rfm.QUINTILES]
    df = spark.range(1, 12).select(right_closed_bin(F.col("id"), F.array(*[F.lit(e) for e in edges])).alias("b"), "id")
    assert [r.b for r in df.orderBy("id").collect()] == [1, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5]


def test_global_row_number_with_a_value_held_by_most_rows(spark):
    rng = random.Random(1)
    rows = [(1 if rng.random() < 0.6 else rng.randrange(9), f"C{i:05d}") for i in range(3000)]
    rng.shuffle(rows)
    got = global_row_number(spark.createDataFrame(rows, "f long, id string").repartition(7), ["f", "id"], "n").collect()
    expected = {key: i + 1 for i, key in enumerate(sorted(rows))}
    assert {(r.f, r.id): r.n for r in got} == expected


@pytest.mark.parametrize("error", [quantiles.RANK_ERROR, -0.01])
def test_two_passes_settle_large_inputs_and_missed_brackets_are_narrowed(spark, monkeypatch, error):
    """With brackets that miss on purpose (error below zero) the rounds find the same values."""
    rounds = []
    narrowed = quantiles._narrowed
    monkeypatch.setattr(quantiles, "_narrowed", lambda *a: rounds.append(1) or narrowed(*a))
    monkeypatch.setattr(quantiles, "RANK_ERROR", error)
    rng = np.random.default_rng(8)
    n = 60000
    values = np.where(rng.random(n) < 0.33, 17.25, np.exp(rng.normal(3, 8, n)))  # a third in one value, the rest over 20 magnitudes
    group = np.where(rng.random(n) < 0.8, "a", "b")
    df = spark.createDataFrame(list(zip(values.tolist(), group.tolist(), strict=True)), "v double, g string").unionByName(
        spark.createDataFrame([(None, "a"), (float("nan"), "c")], "v double, g string"))
    probs = [0.0, 0.001, 0.2, 0.5, 0.8, 0.999, 1.0]
    got = {(r.is_total, r.group): r for r in exact_quantiles(df, "v", probs, "g").collect()}
    assert set(got) == {(True, None), (False, "a"), (False, "b")}
    for (is_total, g), row in got.items():
        mine = values if is_total else values[group == g]
        assert row.n == len(mine)
        np.testing.assert_allclose(row.q, np.quantile(mine, probs), rtol=1e-12)
    assert bool(rounds) == (error < 0)


def test_quantiles_of_values_that_lie_close_together(spark):
    rng = random.Random(4)
    values = [1_000_000 + rng.random() * 500 for _ in range(4000)] + [1e300, -1e300, 0.0, 5e-324] + [1_000_250.0] * 3000
    probs = [0.001, 0.25, 0.5, 0.9, 1.0]
    row, = exact_quantiles(spark.createDataFrame([(v,) for v in values], "v double"), "v", probs).collect()
    np.testing.assert_allclose(row.q, np.quantile(values, probs), rtol=1e-12)


def test_rfm_equals_pandas_quintiles(spark):
    rng = random.Random(11)
    rows = [(f"C{i:04d}", "DE", DAY0 + timedelta(days=rng.randrange(300)), rng.choice([1, 1, 1, 2, 3, 5, 8]),
             round(rng.lognormvariate(5, 1), 2)) for i in range(523)] + [("C9999", "DE", None, 0, 0.0)]
    ltv = spark.createDataFrame(rows, "customer_id string, country_code string, last_order_date date, total_orders long, "
                                      "total_net_revenue_eur double").withColumn("first_order_date", F.col("last_order_date"))
    got = rfm.rfm_segments(rfm.rfm_scores(ltv)).toPandas().sort_values("customer_id").reset_index(drop=True)
    pdf = pd.DataFrame(rows[:-1], columns=["id", "c", "last", "f", "m"]).sort_values("id").reset_index(drop=True)
    age = (pd.to_datetime(pdf["last"]).max() - pd.to_datetime(pdf["last"])).dt.days
    assert (got.recency_days == age).all()

    def fifth(values):
        """1 for the lowest fifth to 5 for the highest; a value on an edge belongs below it."""
        return 1 + np.searchsorted(np.quantile(values, [0.2, 0.4, 0.6, 0.8]), values, side="left")

    place = np.empty(len(pdf))
    place[np.lexsort((pdf.id, pdf.f))] = np.arange(1, len(pdf) + 1)
    assert list(got.r_score) == list(6 - fifth(age.to_numpy(float)))
    assert list(got.f_score) == list(fifth(place))
    assert list(got.m_score) == list(fifth(pdf.m.to_numpy()))
    summary = rfm.rfm_summary(spark.createDataFrame(got)).collect()
    assert sum(r.customers for r in summary) == 523
    assert [r.total_revenue_eur for r in summary] == sorted((r.total_revenue_eur for r in summary), reverse=True)


def test_segment_rules_apply_in_order(spark):
    cases = [(5, 5, 3, "Champions"), (4, 3, 1, "Loyal"), (2, 3, 1, "At Risk"), (1, 2, 5, "Hibernating"),
             (3, 3, 3, "Potential Loyalist"), (5, 2, 1, "Potential Loyalist")]
    df = spark.createDataFrame([(r, f, m, r + f + m, s) for r, f, m, s in cases],
                               "r_score int, f_score int, m_score int, rfm_score int, expected string")
    assert rfm.rfm_segments(df).where("segment <> expected").count() == 0


def test_weekday_baseline_equals_rolling_pandas(spark):
    rng = random.Random(2)
    values = [round(100 + 40 * (i % 7) + rng.gauss(0, 9), 2) for i in range(150)]
    values[100], values[110] = 0.0, 900.0
    got = weekday_baseline(iqr_fence(series(spark, values))).orderBy("date").toPandas()
    for i, v in enumerate(values):
        earlier = values[i % 7:i:7][-8:]  # same weekday, the eight weeks before
        if len(earlier) < 4:
            assert np.isnan(got.seasonal_baseline[i]) and np.isnan(got.seasonal_zscore[i])
        else:
            assert got.seasonal_baseline[i] == pytest.approx(np.median(earlier), rel=1e-9)
            assert got.seasonal_zscore[i] == pytest.approx((v - np.median(earlier)) / np.std(earlier, ddof=1), rel=1e-6)
    q1, q3 = np.quantile(values, [0.25, 0.75])
    assert list(got.iqr_anomaly) == [not q1 - 1.5 * (q3 - q1) <= v <= q3 + 1.5 * (q3 - q1) for v in values]
    assert got.is_anomaly[100] and got.direction[100] == "drop"
    assert got.is_anomaly[110] and got.direction[110] == "spike"


def test_constant_history_gives_no_score(spark):
    got = weekday_baseline(series(spark, [5.0] * 70)).agg(F.count("seasonal_zscore"), F.count_if("is_anomaly")).first()
    assert got[:] == (0, 0)


def test_zscore_of_constant_group_is_null(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 1.0), ("b", 3.0), ("b", None)], "g string, v double")
    got = {(r.g, r.v): r.z for r in group_zscore(df, "v", "g", "z").collect()}
    assert got == {("a", 1.0): None, ("b", 1.0): -1.0, ("b", 3.0): 1.0, ("b", None): None}


def slow_loess(y, span, weights, at):
    """Textbook local regression, one point at a time."""
    n = len(y)
    x = np.arange(1, n + 1, dtype=float)
    width = min(span, n)
    order = np.argsort(np.abs(x - at), kind="stable")[:width]
    h = np.abs(x[order] - at).max() + max(span - n, 0) // 2
    w = np.zeros(n)
    for i in order:
        r = abs(x[i] - at)
        if r <= 0.999 * h:
            w[i] = weights[i] * (1.0 if r <= 0.001 * h else (1 - (r / h) ** 3) ** 3)
    a, b = np.linalg.lstsq(np.sqrt(w)[:, None] * np.c_[np.ones(n), x - at], np.sqrt(w) * y, rcond=None)[0]
    return a


@pytest.mark.parametrize("span", [5, 7, 15])
def test_loess_equals_pointwise_regression(span):
    rng = np.random.default_rng(4)
    y, w = rng.normal(size=40), rng.uniform(0.2, 1, size=40)
    got = stl._loess(y, span, w)
    np.testing.assert_allclose(got, [slow_loess(y, span, w, i + 1) for i in range(40)], rtol=1e-8, atol=1e-10)


def slow_stl(y, period, seasonal, trend_span, low_span, inner, outer):
    """The published procedure written out point by point."""
    n, w, trend = len(y), np.ones(len(y)), np.zeros(len(y))
    for k in range(outer + 1):
        for _ in range(inner):
            cycle = {}
            for phase in range(period):
                days = list(range(phase, n, period))
                sub, sw = (y - trend)[days], w[days]
                for pos in range(len(days) + 2):
                    cycle[phase + (pos - 1) * period] = slow_loess(sub, seasonal, sw, pos)
            c = np.array([cycle[t] for t in range(-period, n + period)])
            for m in (period, period, 3):
                c = np.array([c[t:t + m].mean() for t in range(len(c) - m + 1)])
            low = np.array([slow_loess(c, low_span, np.ones(n), t + 1) for t in range(n)])
            season = np.array([cycle[t] for t in range(n)]) - low
            trend = np.array([slow_loess(y - season, trend_span, w, t + 1) for t in range(n)])
        r = np.abs(y - season - trend)
        h = 6 * np.median(r)
        w = np.where(r <= 0.001 * h, 1, np.where(r <= 0.999 * h, (1 - (r / h) ** 2) ** 2, 0))
    return season, trend


def test_stl_equals_the_procedure_written_out():
    i = np.arange(75)
    y = 50 + 0.1 * i + np.array([3.0, -1, -2, 0, 4, -3, -1])[i % 7] + np.random.default_rng(1).normal(0, 1, 75)
    y[40] += 9
    season, trend = stl.decompose(y, inner=2, outer=3)
    slow_season, slow_trend = slow_stl(y, 7, 7, 15, 9, 2, 3)
    np.testing.assert_allclose(season, slow_season, atol=1e-7)
    np.testing.assert_allclose(trend, slow_trend, atol=1e-7)


def test_stl_recovers_known_parts():
    i = np.arange(364)
    week = np.array([30.0, -10, -20, 0, 40, -30, -10])
    trend = 500 + 0.5 * i
    season, smooth = stl.decompose(trend + week[i % 7] + np.random.default_rng(1).normal(0, 1, 364))
    np.testing.assert_allclose(season, week[i % 7], atol=4)
    np.testing.assert_allclose(smooth, trend, atol=4)


def test_poisson_residuals_flag_planted_days_per_series(spark):
    rng = np.random.default_rng(8)
    counts = rng.poisson(80 + 20 * (np.arange(400) % 7 == 5))
    counts[150], counts[250] = 2, 300
    daily = series(spark, counts * 10.0, counts).withColumn("shop", F.explode(F.array(F.lit("a"), F.lit("b"))))
    got = stl.poisson_residuals(daily, by=["shop"])
    for shop in "ab":
        flagged = {r.date for r in got.where(F.col("shop") == shop).where("stl_poisson_anomaly").collect()}
        assert {DAY0 + timedelta(days=150), DAY0 + timedelta(days=250)} <= flagged and len(flagged) < 12
    short = stl.poisson_residuals(series(spark, [1.0] * 5))
    assert short.where("poisson_z is not null or stl_poisson_anomaly").count() == 0


def test_detector_scores(spark):
    truth = incident_days(spark, [("A", "2024-01-02", "2024-01-04"), ("B", "2024-01-20", "2024-01-20")])
    rows = [("d", DAY0 + timedelta(days=i), i in (1, 2, 9)) for i in range(15)] + [("none", DAY0, False)]
    got = {r.detector: r for r in score_detectors(spark.createDataFrame(rows, "detector string, date date, flagged boolean"), truth).collect()}
    d = got["d"]
    assert (d.flagged, d.tp, d.fp, d.fn) == (3, 2, 1, 2)
    assert math.isclose(d.precision, 2 / 3) and d.recall == 0.5 and math.isclose(d.f1, 4 / 7)
    assert d.incidents_caught == "A: yes, B: no"
    n = got["none"]
    assert (n.flagged, n.fn, n.precision, n.recall, n.f1) == (0, 4, 0.0, 0.0, 0.0)


def test_sweep_never_flags_more_at_a_higher_threshold(spark):
    truth = incident_days(spark, [("A", "2024-01-02", "2024-01-02")])
    rows = [(DAY0 + timedelta(days=i), z) for i, z in enumerate([0.0, 3.5, -4.2, 6.0, None, 3.0])]
    got = sweep_thresholds(spark.createDataFrame(rows, "date date, z double"), truth, "z").orderBy("threshold").collect()
    assert [r.flagged for r in got] == [3, 2, 2, 1, 1]  # strictly greater
    assert [r.tp for r in got] == [1, 0, 0, 0, 0]
