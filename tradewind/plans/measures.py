"""Query-time measures: aggregates under any grouping and filter.

Base measures count every order status. A ratio with a zero denominator is null.
Filters are applied by the caller (``orders.where(...)``), as a report page would; a measure that lifts part of a filter
takes it as an argument. ``by`` may name any columns that the facts have, and the periods ``year``, ``quarter`` and
``month`` of each fact's own date.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.dates import month_start, period_start
from tradewind.functions.numbers import ratio


PERIODS = {"year": 12, "quarter": 3, "month": 1}  # months of each


def _null_safe(left: DataFrame, right: DataFrame, by: Sequence[str], how: str) -> DataFrame:
    """Join two grouped results on ``by``, matching null groups, keeping one copy of the keys.

    Keys meet as one struct, which compares nulls as equal: an equi-join under any grouping, also none.
    """
    def keyed(df: DataFrame, side: str) -> DataFrame:
        key = F.struct(F.lit(0).alias("_all"), *[F.col(c) for c in by]).alias(side)
        return df.select(key, *[c for c in df.columns if c not in by])

    joined = keyed(left, "_l").join(keyed(right, "_r"), F.col("_l") == F.col("_r"), how)
    key = F.coalesce("_l", "_r")
    return joined.select(*[key[c].alias(c) for c in by], *[c for c in joined.columns if c not in ("_l", "_r")])


def _dated(df: DataFrame, day: str, by: Sequence[str]) -> DataFrame:
    """``df`` with the periods that ``by`` names."""
    return df.withColumns({p: period_start(F.col(day), p) for p in PERIODS if p in by})


def order_measures(orders: DataFrame, by: Sequence[str]) -> DataFrame:
    """Net revenue, orders and average order value."""
    sums = orders.groupBy(*by).agg(F.sum("net_amount_eur").cast("double").alias("net_revenue_eur"),
                                   F.count("order_id").alias("orders"))
    return sums.withColumn("avg_order_value_eur", ratio(F.col("net_revenue_eur"), F.col("orders")))


def revenue_against(orders: DataFrame, months: int, prior: str, change: str, by: Sequence[str] = (),
                    period: str = "month") -> DataFrame:
    """Revenue per period beside the revenue of the period ``months`` calendar months earlier.

    A shifted self-join of the period rows, so a missing period gives null
    instead of an earlier one's figure.
    """
    now = _dated(orders, "order_date", [period]).groupBy(*by, period).agg(
        F.sum("net_amount_eur").cast("double").alias("net_revenue_eur"))
    then = now.select(*by, F.add_months(period, months).alias(period), F.col("net_revenue_eur").alias(prior))
    both = now.join(then, [*by, period], "left")
    return both.withColumn(change, ratio(F.col("net_revenue_eur") - F.col(prior), F.col(prior)))


def revenue_yoy(orders: DataFrame, by: Sequence[str] = (), period: str = "month") -> DataFrame:
    return revenue_against(orders, 12, "net_revenue_ly_eur", "revenue_yoy", by, period)


def revenue_mom_calendar(orders: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return revenue_against(orders, 1, "net_revenue_pm_eur", "revenue_mom", by)


def cancel_rate(orders: DataFrame, by: Sequence[str], where: Mapping[str, Sequence] | None = None) -> DataFrame:
    """Cancelled orders over all orders; of the filter ``where`` (column: values) the one on status is lifted."""
    for column, values in (where or {}).items():
        if column != "status":
            orders = orders.where(F.col(column).isin(*values))
    sums = orders.groupBy(*by).agg(F.count_if(F.col("status") == "cancelled").alias("cancelled_orders"),
                                   F.count("order_id").alias("orders"))
    return sums.withColumn("cancelled_order_rate", ratio(F.col("cancelled_orders"), F.col("orders")))


def active_customers(orders: DataFrame, by: Sequence[str]) -> DataFrame:
    """Distinct ordering customers, counted in two steps so a hot group spreads over its customers."""
    return orders.groupBy(*by, "customer_id").agg(F.count("*").alias("_n")).groupBy(*by).agg(
        F.count("customer_id").alias("active_customers"))


def new_customers(customers: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Customers by signup month."""
    return customers.where("signup_date is not null").groupBy(
        *by, month_start(F.col("signup_date")).alias("month")).agg(F.count("customer_id").alias("new_customers"))


def customer_measures(orders: DataFrame, ltv: DataFrame, by: Sequence[str]) -> DataFrame:
    """Active customers, mean lifetime value, repeat purchase rate and churn rate."""
    bought = F.count_if(F.col("total_orders") > 0)
    value = ltv.groupBy(*by).agg(
        F.sum(F.col("total_net_revenue_eur").cast("decimal(38,2)")).cast("double").alias("_rev"),
        F.count("*").alias("customers"), bought.alias("purchasers"),
        F.count_if(F.col("total_orders") > 1).alias("_repeat"),
        F.count_if(F.col("lifecycle_stage") == "churned").alias("_churned"))
    value = value.select(
        *by, "customers", "purchasers", ratio(F.col("_rev"), F.col("customers")).alias("mean_ltv_eur"),
        ratio(F.col("_repeat"), F.col("purchasers")).alias("repeat_purchase_rate"),
        ratio(F.col("_churned"), F.col("purchasers")).alias("churn_rate"))
    return _null_safe(active_customers(orders, by), value, by, "full")


def product_measures(items: DataFrame, products: DataFrame, by: Sequence[str]) -> DataFrame:
    """Gross margin and margin share by product attributes; lines are summed per product before the join."""
    per_product = items.groupBy("product_id").agg(F.sum("line_margin_eur").alias("_m"),
                                                  F.sum("line_total_eur").alias("_t"))
    sums = per_product.join(products.select("product_id", *by), "product_id", "left").groupBy(*by).agg(
        F.sum("_m").cast("double").alias("gross_margin_eur"), F.sum("_t").cast("double").alias("_t"))
    return sums.select(*by, "gross_margin_eur", ratio(F.col("gross_margin_eur"), F.col("_t")).alias("gross_margin_share"))


def return_measures(returns: DataFrame, orders: DataFrame, by: Sequence[str] = ("month",)) -> DataFrame:
    """Returned orders over orders, and refunds.

    Each fact is aggregated on its own date before the two meet. Returned orders
    are counted distinct in two steps.
    """
    per_order = _dated(returns, "return_date", by).groupBy(*by, "order_id").agg(F.sum("refund_amount_eur").alias("_r"))
    back = per_order.groupBy(*by).agg(F.count("order_id").alias("returned_orders"),
                                      F.sum("_r").cast("double").alias("total_refunded_eur"))
    sold = _dated(orders, "order_date", by).groupBy(*by).agg(F.count("order_id").alias("orders"))
    both = _null_safe(sold, back, by, "full")
    returned = F.coalesce("returned_orders", F.lit(0))
    return both.withColumn("returned_orders", returned).withColumn(
        "return_rate", ratio(F.col("returned_orders"), F.col("orders")))


def marketing_measures(spend: DataFrame, orders: DataFrame, by: Sequence[str] = ("country_code", "month")) -> DataFrame:
    """Spend, true blended return, cost per conversion and click-through."""
    spent = _dated(spend, "date", by).groupBy(*by).agg(
        F.sum("spend_eur").cast("double").alias("marketing_spend_eur"), F.sum("impressions").alias("_i"),
        F.sum("clicks").alias("_k"), F.sum("conversions").alias("_c"))
    earned = _dated(orders, "order_date", by).groupBy(*by).agg(F.sum("net_amount_eur").cast("double").alias("net_revenue_eur"))
    both = _null_safe(spent, earned, by, "full")
    return both.select(
        *by, "marketing_spend_eur", "net_revenue_eur",
        ratio(F.col("net_revenue_eur"), F.col("marketing_spend_eur")).alias("blended_roas"),
        ratio(F.col("marketing_spend_eur"), F.col("_c")).alias("cost_per_conversion_eur"),
        ratio(F.col("_k"), F.col("_i")).alias("click_through_rate"))


def anomaly_overlay(calendar: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Revenue on flagged days, blank on all other calendar days."""
    marks = anomalies.select(F.col("date").alias("date_day"), F.col("net_revenue_eur").alias("anomaly_revenue_eur"))
    return calendar.select("date_day").join(marks, "date_day", "left")
