"""Raw extracts to clean tables: one lazy transform per table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions.dates import lenient_date, mixed_date, strict_date
from tradewind.functions.text import canonical, normalize_code, strip, within_domain
from tradewind.operators.dedupe import distinct_rows, keep_first
from tradewind.operators.impute import fill_by_median_ratio
from tradewind.sources.schemas import BASE_CURRENCY, CATEGORIES, COUNTRY_CODES

NEGATIVE_FLAG = "corrected_negative_amount"
UNKNOWN_COUNTRY = "UNK"
UNKNOWN_CATEGORY = "Unknown"
UNSPECIFIED = "unspecified"
ORDER_KEY = "ingest_seq"


def clean_customers(raw: DataFrame, countries: Sequence[str] = COUNTRY_CODES) -> DataFrame:
    """One row per customer_id; unknown countries become UNK; missing emails stay null.

    The opt-in text is cast as a boolean, so "False" is false and null stays
    null. (Coercing any non-empty text to true would lose the information.)
    """
    return keep_first(raw, ["customer_id"], ORDER_KEY).select(
        "customer_id",
        strip(F.col("first_name")).alias("first_name"),
        strip(F.col("last_name")).alias("last_name"),
        "email", "gender",
        lenient_date(F.col("birth_date")).alias("birth_date"),
        lenient_date(F.col("signup_date")).alias("signup_date"),
        within_domain(normalize_code(F.col("country_code")), countries, UNKNOWN_COUNTRY).alias("country_code"),
        "city", "acquisition_channel",
        F.col("marketing_opt_in").try_cast("boolean").alias("marketing_opt_in"))


def with_canonical_category(raw: DataFrame, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    return raw.withColumn("category", canonical(F.col("category"), categories, UNKNOWN_CATEGORY))


def clean_products(raw: DataFrame, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """Canonical categories; missing costs from the category's median cost-to-price ratio."""
    named = with_canonical_category(raw, categories)
    filled = fill_by_median_ratio(named, "unit_cost_eur", "unit_price_eur", "category")
    return filled.withColumn("launch_date", lenient_date(F.col("launch_date")))


def clean_orders(raw: DataFrame) -> DataFrame:
    """One row per order_id, ISO dates, upper-case codes, positive amounts with a flag where the sign was wrong.

    The gross amount is taken over under its EUR name without conversion.
    Country codes are normalised but not checked against the domain.
    """
    wrong_sign = F.col("net_amount_eur") < 0
    return keep_first(raw, ["order_id"], ORDER_KEY).select(
        "order_id", "customer_id",
        mixed_date(F.col("order_date")).alias("order_date"),
        normalize_code(F.col("country_code")).alias("country_code"),
        "channel", "status",
        normalize_code(F.col("currency_code")).alias("currency_code"),
        "discount_amount_eur", "shipping_fee_eur",
        F.abs("net_amount_eur").alias("net_amount_eur"),
        F.when(wrong_sign, F.lit(NEGATIVE_FLAG)).alias("data_quality_flag"),
        F.abs("gross_amount_local").alias("gross_amount_eur"))


def clean_items(raw: DataFrame) -> DataFrame:
    return distinct_rows(raw)


def clean_payments(raw: DataFrame) -> DataFrame:
    return keep_first(raw, ["order_id"], ORDER_KEY).select(
        "order_id", F.lower(strip(F.col("payment_method"))).alias("payment_method"), "payment_status")


def clean_returns(raw: DataFrame) -> DataFrame:
    return raw.withColumn("return_date", mixed_date(F.col("return_date"))).withColumn(
        "return_reason", F.coalesce("return_reason", F.lit(UNSPECIFIED)))


def clean_spend(raw: DataFrame) -> DataFrame:
    """Negative spend becomes 0; a date that does not parse fails the job."""
    spend = F.col("spend_eur")
    floor = F.lit(0).cast(raw.schema["spend_eur"].dataType)
    return raw.withColumn("date", strict_date(F.col("date"))).withColumn(
        "spend_eur", F.when(spend < 0, floor).otherwise(spend))


def add_base_rates(rates: DataFrame, base: str = BASE_CURRENCY) -> DataFrame:
    """Append a rate of 1 for the base currency on every day that has any rate."""
    kind = rates.schema["rate_to_eur"].dataType
    own = rates.select("date").distinct().select(
        "date", F.lit(base).alias("currency_code"), F.lit(1).cast(kind).alias("rate_to_eur"))
    return rates.unionByName(own)


def clean_rates(raw: DataFrame) -> DataFrame:
    """Rates quote units of currency per EUR, whatever the column name suggests."""
    return add_base_rates(raw.withColumn("date", strict_date(F.col("date"))))
