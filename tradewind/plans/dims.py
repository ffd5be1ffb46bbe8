"""Dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.numbers import ratio, round_to
from tradewind.operators.calendar import day_spine


def dim_customer(customers: DataFrame, countries: DataFrame) -> DataFrame:
    """Customers with country name and region; unknown codes keep null there."""
    named = countries.select("country_code", "country_name", "region")
    return customers.join(named, "country_code", "left").select(
        "customer_id", "first_name", "last_name", "email", "gender", "birth_date", "signup_date", "country_code",
        "country_name", "region", "city", "acquisition_channel", "marketing_opt_in")


def dim_product(products: DataFrame) -> DataFrame:
    margin = F.col("unit_price_eur") - F.col("unit_cost_eur")
    return products.select(
        "product_id", "product_name", "category", "brand", "unit_cost_eur", "unit_price_eur",
        F.round(margin, 2).alias("unit_margin_eur"),
        round_to(ratio(margin, F.col("unit_price_eur")) * 100, 2).alias("unit_margin_pct"),
        "launch_date")


def dim_date(bounds: DataFrame) -> DataFrame:
    """Calendar attributes for each day between ``lo`` and ``hi`` of the one-row frame."""
    d = F.col("date_day")
    iso_day = (F.weekday(d) + 1).cast("long")
    return day_spine(bounds, day="date_day").select(
        "date_day", F.year(d).cast("long").alias("year"), F.quarter(d).cast("long").alias("quarter"),
        F.month(d).cast("long").alias("month"), F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).cast("long").alias("iso_week"), iso_day.alias("day_of_week"),
        iso_day.isin(6, 7).alias("is_weekend"))
