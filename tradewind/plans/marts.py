"""Analytic marts over the staged tables.

``orders`` means orders whose order_id is unique (cleaning guarantees it, the
data tests check it), so counting rows counts distinct orders.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.dates import month_start, months_apart
from tradewind.functions.numbers import ratio, round_to
from tradewind.scale import materialize

ACTIVE_DAYS, AT_RISK_DAYS = 90, 180


def completed(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("status") == "completed")


def _money(c: str) -> Column:
    return F.sum(c).cast("double")


def _in_units(df: DataFrame, c: str) -> tuple[Column, Callable[[Column], Column]]:
    """A decimal column as a whole number of its last digit's units, and the way back for their sums.

    Decimals too wide for a long, and other types, stay as they are.
    """
    kind = df.schema[c].dataType
    if not isinstance(kind, T.DecimalType) or kind.precision + kind.scale + 2 > 18:
        return F.col(c), lambda x: x
    unit = F.lit(Decimal(1).scaleb(-kind.scale))
    return (F.col(c) * F.lit(10**kind.scale)).cast("long"), lambda x: x.cast("decimal(20,0)") * unit


def monthly_revenue_kpis(orders: DataFrame) -> DataFrame:
    """Orders, customers, revenue and growth per (month, country).

    Aggregates per customer first: that one exchange replaces the row expansion
    two distinct counts would need, and spreads a country holding a third of all
    orders over its customers. Growth compares with the previous month present.
    """
    per_customer = completed(orders).groupBy(
        month_start(F.col("order_date")).alias("month"), "country_code", "customer_id"
    ).agg(F.count("order_id").alias("_n"), F.sum("net_amount_eur").alias("_rev"))
    monthly = per_customer.groupBy("month", "country_code").agg(
        F.sum("_n").alias("orders_count"), F.count("customer_id").alias("active_customers"),
        _money("_rev").alias("net_revenue_eur"))
    monthly = monthly.withColumn(
        "avg_order_value_eur", round_to(ratio(F.col("net_revenue_eur"), F.col("orders_count")), 2))
    by_month = Window.partitionBy("country_code").orderBy("month")
    before, now = F.col("prev_month_revenue_eur"), F.col("net_revenue_eur")
    return (monthly.withColumn("prev_month_revenue_eur", F.lag("net_revenue_eur").over(by_month))
            .withColumn("mom_revenue_growth_pct", round_to(ratio(round_to(now - before, 2), before) * 100, 2)))


def customer_ltv(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Lifetime figures and lifecycle stage of every customer, with or without orders.

    The stage is relative to the last completed order in the data. A customer
    holding a third of the orders is pre-aggregated before the exchange. The
    per-customer sums are written once: the reference date is their maximum, and
    taking it from there spares a second pass over the orders.
    """
    per_customer = materialize(completed(orders).groupBy("customer_id").agg(
        F.min("order_date").alias("first_order_date"), F.max("order_date").alias("last_order_date"),
        F.count("order_id").alias("_n"), _money("net_amount_eur").alias("_rev")), "customer_sums")
    as_of = per_customer.agg(F.max("last_order_date")).scalar()
    idle = F.date_diff(as_of, F.col("last_order_date"))
    stage = (F.when(F.col("_n").isNull(), "never_purchased").when(idle <= ACTIVE_DAYS, "active")
             .when(idle <= AT_RISK_DAYS, "at_risk").otherwise("churned"))
    return customers.join(per_customer, "customer_id", "left").select(
        "customer_id", "country_code", "region", "acquisition_channel", "signup_date", "first_order_date",
        "last_order_date", F.coalesce("_n", F.lit(0)).alias("total_orders"),
        F.coalesce("_rev", F.lit(0.0)).alias("total_net_revenue_eur"),
        round_to(ratio(F.col("_rev"), F.col("_n")), 2).alias("avg_order_value_eur"),
        F.date_diff("last_order_date", "first_order_date").cast("long").alias("customer_lifespan_days"),
        stage.alias("lifecycle_stage"))


def cohort_retention(orders: DataFrame) -> DataFrame:
    """Share of each first-order month's customers that order again in later months.

    One exchange by customer carries the set of active months (bounded by the
    calendar, combined before the exchange); its minimum is the cohort. No
    self-join and no window over orders.
    """
    month = month_start(F.col("order_date"))
    undated = F.bool_or(F.col("order_date").isNull())
    per_customer = completed(orders).where("customer_id is not null").groupBy("customer_id").agg(
        F.collect_set(month).alias("_months"), undated.alias("_undated"))
    no_month = F.array(F.lit(None).cast("date"))
    months = F.when(F.col("_undated"), F.concat("_months", no_month)).otherwise(F.col("_months"))
    active = per_customer.select(F.array_min("_months").alias("cohort_month"), F.explode(months).alias("order_month"))
    counted = active.where("cohort_month is not null").groupBy("cohort_month", "order_month").agg(
        F.count("*").alias("active_customers"))
    counted = counted.withColumn(
        "months_since_first_order", months_apart(F.col("order_month"), F.col("cohort_month")))
    start = F.when(F.col("months_since_first_order") == 0, F.col("active_customers"))
    cohort = Window.partitionBy("cohort_month")
    return counted.withColumn("cohort_size", F.max(start).over(cohort)).select(
        "cohort_month", "order_month", "months_since_first_order", "active_customers", "cohort_size",
        round_to(ratio(F.col("active_customers"), F.col("cohort_size")) * 100, 2).alias("retention_rate_pct"))


def product_performance(products: DataFrame, items: DataFrame, returns: DataFrame,
                        fan_out: bool = True) -> DataFrame:
    """Sales, margin and returns per product, every order status included.

    A return belongs to an order, so it counts against each product of that
    order. With ``fan_out`` an order with several returns also counts its lines
    that many times, as joining lines to returns does; without it lines count
    once. Either way the rows are never multiplied: returns are counted per
    order, lines are summed per (product, order), and the two are multiplied.
    The join on order_id leaves the lines where the sums per (product, order)
    need them, so the lines cross the network once; AQE splits a hot order and
    only then adds the exchange the split costs. Return ids are unique, which
    the data tests check. A product has one unit cost, so its margin follows
    from its summed revenue and units: lines are not joined to products at all.
    Amounts are summed as whole cents in a long rather than as wide decimals; a
    sum beyond 9.2e16 EUR fails the job.
    """
    cents, amount = _in_units(items, "line_total_eur")
    per_order = returns.groupBy("order_id").agg(
        F.count("*").alias("_rows"), F.count_distinct("return_id").alias("_ids"))
    lines = items.select("product_id", "order_id", "quantity", cents.alias("_c")).join(per_order, "order_id", "left")
    per_line = lines.groupBy("product_id", "order_id").agg(
        F.sum("quantity").alias("_q"), F.sum("_c").alias("_c"),
        F.max("_rows").alias("_rows"), F.max("_ids").alias("_ids"))
    times = F.coalesce("_rows", F.lit(1)) if fan_out else F.lit(1)
    sold = per_line.groupBy("product_id").agg(
        F.count("order_id").alias("_orders"), F.sum(F.col("_q") * times).alias("units_sold"),
        F.sum(F.col("_c") * times).alias("_c"), F.sum("_ids").alias("_returns"))
    orders, back = F.coalesce("_orders", F.lit(0)), F.coalesce("_returns", F.lit(0))
    sold = sold.withColumn("_t", amount(F.col("_c")))
    margin = F.col("_t") - F.col("units_sold").cast("decimal(20,0)") * F.col("unit_cost_eur")
    known = products.select("product_id", "product_name", "category", "brand", "unit_cost_eur")
    return known.join(sold, "product_id", "left").withColumns(
        {"gross_revenue_eur": F.col("_t").cast("double"), "gross_margin_eur": margin.cast("double")}).select(
        "product_id", "product_name", "category", "brand", orders.alias("orders_count"), "units_sold",
        "gross_revenue_eur", "gross_margin_eur",
        round_to(ratio(F.col("gross_margin_eur"), F.col("gross_revenue_eur")) * 100, 2).alias("margin_pct"),
        back.alias("returns_count"), round_to(ratio(back, orders) * 100, 2).alias("return_rate_pct"))


def marketing_roi(spend: DataFrame, orders: DataFrame) -> DataFrame:
    """Spend per (country, month, channel) beside the country's revenue of that month.

    ``blended_roas`` divides the whole country-month revenue by this channel's
    spend. Both facts are aggregated to their grain before they meet.
    """
    spent = spend.groupBy("country_code", month_start(F.col("date")).alias("month"), "channel").agg(
        _money("spend_eur").alias("spend_eur"), F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"), F.sum("conversions").alias("conversions"))
    earned = completed(orders).groupBy("country_code", month_start(F.col("order_date")).alias("month")).agg(
        _money("net_amount_eur").alias("net_revenue_eur"), F.count("order_id").alias("orders_count"))
    return spent.join(earned, ["country_code", "month"], "left").select(
        "country_code", "month", "channel", "spend_eur", "impressions", "clicks", "conversions",
        round_to(ratio(F.col("spend_eur"), F.col("conversions")), 2).alias("cost_per_conversion_eur"),
        "net_revenue_eur", "orders_count",
        round_to(ratio(F.col("net_revenue_eur"), F.col("spend_eur")), 2).alias("blended_roas"))


def returns_analysis(returns: DataFrame) -> DataFrame:
    return returns.groupBy(month_start(F.col("return_date")).alias("month"), "return_reason").agg(
        F.count("*").alias("returns_count"), _money("refund_amount_eur").alias("total_refund_eur"),
        round_to(F.avg("days_to_return"), 1).alias("avg_days_to_return"))


def daily_revenue(orders: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Completed revenue and orders per day that has any."""
    return completed(orders).groupBy(*by, F.col("order_date").alias("date")).agg(
        _money("net_amount_eur").alias("net_revenue_eur"), F.count("order_id").alias("orders_count"))
