"""Column lists of the eight raw extracts and the fixed values of the domain."""

from __future__ import annotations

# The retail domain of the analytics model.
COUNTRY_CODES = ("DE", "FR", "GB", "NL", "ES", "IT", "SE")
CATEGORIES = (
    "Electronics",
    "Fashion",
    "Home & Garden",
    "Beauty & Health",
    "Sports & Outdoors",
    "Toys & Kids",
    "Books & Media",
    "Grocery",
)
ORDER_STATUSES = ("completed", "cancelled")
BASE_CURRENCY = "EUR"

# Country seed (code, name, currency, region).
COUNTRY_SEED = (
    ("DE", "Germany", "EUR", "Western Europe"),
    ("FR", "France", "EUR", "Western Europe"),
    ("GB", "United Kingdom", "GBP", "Western Europe"),
    ("NL", "Netherlands", "EUR", "Western Europe"),
    ("ES", "Spain", "EUR", "Southern Europe"),
    ("IT", "Italy", "EUR", "Southern Europe"),
    ("SE", "Sweden", "SEK", "Nordic"),
)
COUNTRY_COLUMNS = ("country_code", "country_name", "currency_code", "region")

# Raw extracts. Dates, codes and flags stay text until cleaned.
RAW_SCHEMAS = {
    "customers": "customer_id string, first_name string, last_name string, email string, gender string, "
    "birth_date string, signup_date string, country_code string, city string, "
    "acquisition_channel string, marketing_opt_in string",
    "products": "product_id string, product_name string, category string, brand string, "
    "unit_cost_eur decimal(10,2), unit_price_eur decimal(10,2), launch_date string",
    "orders": "order_id string, customer_id string, order_date string, country_code string, channel string, "
    "status string, currency_code string, gross_amount_local decimal(12,2), "
    "discount_amount_eur decimal(12,2), shipping_fee_eur decimal(12,2), net_amount_eur decimal(12,2)",
    "order_items": "order_id string, product_id string, quantity int, unit_price_eur decimal(10,2), "
    "line_total_eur decimal(12,2)",
    "payments": "order_id string, payment_method string, payment_status string",
    "returns": "return_id string, order_id string, return_date string, return_reason string, "
    "refund_amount_eur decimal(12,2)",
    "marketing_spend": "date string, country_code string, channel string, spend_eur decimal(18,2), "
    "impressions bigint, clicks bigint, conversions bigint",
    "exchange_rates": "date string, currency_code string, rate_to_eur decimal(10,4)",
}

# Extracts that are de-duplicated keep-first and therefore need a record order.
ORDERED_EXTRACTS = ("customers", "orders", "payments")

# Cell texts a CSV reader in the pandas tradition takes for missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
