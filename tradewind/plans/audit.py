"""Data-quality counts of the cleaning step, as a table and as log lines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.dates import dashed_not_iso, has_slash
from tradewind.functions.numbers import plain_number, ratio
from tradewind.functions.text import normalize_code
from tradewind.operators.dedupe import distinct_rows, keep_first
from tradewind.plans.clean import ORDER_KEY
from tradewind.sources.schemas import COUNTRY_CODES


def null_audit(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """(table_name, column_name, null_rows, null_share) in one pass over the table."""
    counts = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("n")) for c in columns]))
    return counts.select("_n", rows.alias("_r")).select(
        F.lit(table).alias("table_name"), F.col("_r.c").alias("column_name"), F.col("_r.n").alias("null_rows"),
        ratio(F.col("_r.n"), F.col("_n")).alias("null_share"))


def _counts(df: DataFrame, table: str, rules: Mapping[str, Column], raw: DataFrame | None = None) -> DataFrame:
    """One aggregation per table; ``raw`` adds how many rows de-duplication dropped."""
    one = df.agg(F.count("*").alias("rows_written"), *[c.alias(rule) for rule, c in rules.items()])
    names = [*rules, "rows_written"]
    if raw is not None:
        before = raw.agg(F.count("*")).scalar()
        one = one.withColumn("duplicates_dropped", before - F.col("rows_written"))
        names = ["duplicates_dropped", *names]
    rows = F.explode(F.array(*[
        F.struct(F.lit(n).alias("rule"), F.col(n).cast("long").alias("rows_affected")) for n in names]))
    return one.select("rows_written", rows.alias("_r")).select(
        F.lit(table).alias("table_name"), "_r.rule", "_r.rows_affected",
        ratio(F.col("_r.rows_affected"), F.col("rows_written")).alias("share"))


def dq_report(raw: Mapping[str, DataFrame], countries: Sequence[str] = COUNTRY_CODES) -> DataFrame:
    """(table_name, rule, rows_affected, share): what cleaning repaired in each extract.

    Rules are counted on the rows that survive de-duplication, straight from the
    raw columns, so every extract is read for counting once.
    """
    customers = keep_first(raw["customers"], ["customer_id"], ORDER_KEY)
    orders = keep_first(raw["orders"], ["order_id"], ORDER_KEY)
    code = normalize_code(F.col("country_code"))
    spend, rates = raw["marketing_spend"], raw["exchange_rates"]
    base_days = rates.select("date").distinct().agg(F.count("*").alias("base_rows_added"))
    rate_rows = rates.agg(F.count("*")).scalar()
    parts = [
        _counts(customers, "customers", {
            "unknown_country": F.count_if(F.coalesce(~code.isin(*countries), F.lit(True))),
            "missing_email": F.count_if(F.col("email").isNull())}, raw["customers"]),
        _counts(raw["products"], "products", {"cost_imputed": F.count_if(F.col("unit_cost_eur").isNull())}),
        _counts(orders, "orders", {
            "slash_dates": F.count_if(has_slash(F.col("order_date"))),
            "sign_corrected": F.count_if(F.col("net_amount_eur") < 0)}, raw["orders"]),
        _counts(distinct_rows(raw["order_items"]), "order_items", {}, raw["order_items"]),
        _counts(keep_first(raw["payments"], ["order_id"], ORDER_KEY), "payments", {}),
        _counts(raw["returns"], "returns", {
            "dashed_dates": F.count_if(dashed_not_iso(F.col("return_date"))),
            "reason_filled": F.count_if(F.col("return_reason").isNull())}),
        _counts(spend, "marketing_spend", {"spend_clipped": F.count_if(F.col("spend_eur") < 0)}),
        base_days.withColumn("rows_written", rate_rows + F.col("base_rows_added")).select(
            "rows_written", F.explode(F.array(
                F.struct(F.lit("base_rows_added").alias("rule"), F.col("base_rows_added").alias("n")),
                F.struct(F.lit("rows_written").alias("rule"), F.col("rows_written").alias("n")))).alias("_r")).select(
            F.lit("exchange_rates").alias("table_name"), "_r.rule", F.col("_r.n").alias("rows_affected"),
            ratio(F.col("_r.n"), F.col("rows_written")).alias("share")),
    ]
    return reduce(DataFrame.unionByName, parts)


def nonstandard_dates(orders: DataFrame, returns: DataFrame) -> DataFrame:
    """(table_name, nonstandard_rows): dates with slashes, and dashed dates that are not ISO."""
    return orders.agg(F.count_if(has_slash(F.col("order_date"))).alias("nonstandard_rows")).select(
        F.lit("orders").alias("table_name"), "nonstandard_rows").unionByName(
        returns.agg(F.count_if(dashed_not_iso(F.col("return_date"))).alias("nonstandard_rows")).select(
            F.lit("returns").alias("table_name"), "nonstandard_rows"))


#: how the log names what a rule counts
WORDING = {
    "duplicates_dropped": "repeated rows left out", "unknown_country": "country outside the list", "missing_email": "no email given",
    "cost_imputed": "unit cost estimated", "slash_dates": "date written with slashes", "dashed_dates": "date written day first",
    "sign_corrected": "amount below zero", "reason_filled": "no reason given", "spend_clipped": "spend below zero",
    "base_rows_added": "days added for the base currency", "rows_written": "rows kept",
}


def dq_messages(report: DataFrame) -> DataFrame:
    """(table_name, rule, rows_affected, message): each rule that met any row as ``name: rows (share of the rows kept)``."""
    named = F.create_map(*[F.lit(x) for pair in WORDING.items() for x in pair])
    share = F.concat(F.lit(" ("), plain_number(F.col("share") * 100, 1), F.lit("%)"))
    told = F.concat(named[F.col("rule")], F.lit(": "), F.format_string("%,d", "rows_affected"),
                    F.when(F.col("rule") == "rows_written", F.lit("")).otherwise(share))
    return report.where("rows_affected > 0").select("table_name", "rule", "rows_affected", told.alias("message"))


def dq_lines(report: DataFrame) -> DataFrame:
    """The messages as lines of a log."""
    return dq_messages(report).select("table_name", "rule", F.concat_ws(" | ", "table_name", "message").alias("line"))
