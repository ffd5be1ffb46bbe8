"""Typed projections of the clean tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Column -> type per staged table, in output order. None passes the column through.
STAGED = {
    "customers": {
        "customer_id": None, "first_name": None, "last_name": None, "email": None, "gender": None,
        "birth_date": "date", "signup_date": "date", "country_code": None, "city": None,
        "acquisition_channel": None, "marketing_opt_in": None},
    "products": {
        "product_id": None, "product_name": None, "category": None, "brand": None,
        "unit_cost_eur": "decimal(10,2)", "unit_price_eur": "decimal(10,2)", "launch_date": "date"},
    "orders": {
        "order_id": None, "customer_id": None, "order_date": "date", "country_code": None, "channel": None,
        "status": None, "currency_code": None, "gross_amount_eur": "decimal(12,2)",
        "discount_amount_eur": "decimal(12,2)", "shipping_fee_eur": "decimal(12,2)",
        "net_amount_eur": "decimal(12,2)", "data_quality_flag": None},
    "order_items": {
        "order_id": None, "product_id": None, "quantity": "int", "unit_price_eur": "decimal(10,2)",
        "line_total_eur": "decimal(12,2)"},
    "payments": {"order_id": None, "payment_method": None, "payment_status": None},
    "returns": {
        "return_id": None, "order_id": None, "return_date": "date", "return_reason": None,
        "refund_amount_eur": "decimal(12,2)"},
    # daily spend is an aggregate already, so it gets more room than single amounts
    "marketing_spend": {
        "date": "date", "country_code": None, "channel": None, "spend_eur": "decimal(18,2)",
        "impressions": "bigint", "clicks": "bigint", "conversions": "bigint"},
    "exchange_rates": {"date": "date", "currency_code": None, "rate_to_eur": "decimal(10,4)"},
}


def stage(clean: DataFrame, table: str) -> DataFrame:
    return clean.select(*[
        F.col(c).cast(kind).alias(c) if kind else F.col(c) for c, kind in STAGED[table].items()])
