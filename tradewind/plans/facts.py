"""Fact tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.numbers import ratio, round_to


def fct_orders(orders: DataFrame, items: DataFrame, payments: DataFrame, rates: DataFrame) -> DataFrame:
    """Orders with item count, payment method and the amount in the order's currency.

    Orders, item counts and payments all arrive partitioned by order_id, so the
    two joins on it need no further exchange. Rates match on day and currency
    exactly; a missing rate counts as 1.
    """
    item_counts = items.groupBy("order_id").agg(F.count("*").alias("order_item_count"))
    fx = rates.select(F.col("date").alias("order_date"), "currency_code", F.col("rate_to_eur").alias("_rate"))
    rate = F.coalesce("_rate", F.lit(1).cast(rates.schema["rate_to_eur"].dataType))
    return (orders.join(item_counts, "order_id", "left")
            .join(payments.select("order_id", "payment_method"), "order_id", "left")
            .join(fx, ["order_date", "currency_code"], "left")
            .select("order_id", "customer_id", "order_date", "country_code", "channel", "status", "currency_code",
                    rate.alias("fx_rate_to_eur"), "gross_amount_eur", "discount_amount_eur", "shipping_fee_eur",
                    "net_amount_eur", F.round(F.col("net_amount_eur") * rate, 2).alias("net_amount_local_currency"),
                    "payment_method", F.coalesce("order_item_count", F.lit(0)).alias("order_item_count"),
                    "data_quality_flag"))


def fct_order_items(items: DataFrame, products: DataFrame) -> DataFrame:
    """Lines with cost and margin; a hot product is split by AQE on the line side of the left join."""
    cost = F.col("quantity") * F.col("unit_cost_eur")
    return items.join(products.select("product_id", "unit_cost_eur"), "product_id", "left").select(
        "order_id", "product_id", "quantity", "unit_price_eur", "line_total_eur",
        F.round(cost, 2).alias("line_cost_eur"),
        F.round(F.col("line_total_eur") - cost, 2).alias("line_margin_eur"))


def fct_returns(returns: DataFrame, orders: DataFrame) -> DataFrame:
    return returns.join(orders.select("order_id", "order_date"), "order_id", "left").select(
        "return_id", "order_id", "return_date", "return_reason", "refund_amount_eur", "order_date",
        F.date_diff("return_date", "order_date").cast("long").alias("days_to_return"))


def fct_marketing_spend(spend: DataFrame) -> DataFrame:
    return spend.select(
        "date", "country_code", "channel", "spend_eur", "impressions", "clicks", "conversions",
        round_to(ratio(F.col("clicks"), F.col("impressions")), 4).alias("ctr"),
        round_to(ratio(F.col("conversions"), F.col("clicks")), 4).alias("click_to_conversion_rate"),
        round_to(ratio(F.col("spend_eur"), F.col("conversions")), 2).alias("cost_per_conversion_eur"))
