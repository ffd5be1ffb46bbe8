"""The validated figures a report may quote, as tidy rows.

Columns: section, rank, entity, metric, value_num, value_str. The size is
bounded: top-k lists, five segments and one row per country.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions.numbers import round_to
from tradewind.operators.claims import numbers_in
from tradewind.plans import feeds

COLUMNS = ("section", "rank", "entity", "metric", "value_num", "value_str")


def _facts(df: DataFrame, section: str, order: Sequence[Column], entity: Column,
           metrics: Mapping[str, Column]) -> DataFrame:
    """Rank the (few) rows of a section and turn each metric column into a row."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)).cast("long"))
    types = dict(zip(metrics, (ranked.select(*[c.alias(m) for m, c in metrics.items()]).schema)))
    cells = []
    for m, c in metrics.items():
        text = types[m].dataType.typeName() in ("string", "date")
        num, txt = (F.lit(None), c.cast("string")) if text else (c, F.lit(None))
        cells.append(F.struct(F.lit(m).alias("metric"), num.cast("double").alias("value_num"),
                              txt.cast("string").alias("value_str")))
    return ranked.select(F.lit(section).alias("section"), F.col("_rank").alias("rank"), entity.alias("entity"),
                         F.explode(F.array(*cells)).alias("_m")).select(
        "section", "rank", "entity", "_m.metric", "_m.value_num", "_m.value_str")


def _two(c: str) -> Column:
    return round_to(F.col(c), 2)


def headline(kpis: DataFrame) -> DataFrame:
    one = kpis.agg(F.max("month").alias("latest_month"),
                   F.sum(F.col("net_revenue_eur").cast("decimal(38,2)")).cast("double").alias("total_revenue_eur"),
                   F.sum("orders_count").alias("total_orders"))
    return _facts(one, "headline", [F.col("latest_month")], F.lit("all"), {
        "latest_month": F.col("latest_month"), "total_revenue_eur": F.col("total_revenue_eur"),
        "total_orders": F.col("total_orders")})


def gather(kpis: DataFrame, returns: DataFrame, products: DataFrame, anomalies: DataFrame | None = None,
           segments: DataFrame | None = None, low_roas: DataFrame | None = None) -> DataFrame:
    """All sections in one frame; the optional inputs' sections are left out when missing.

    ``kpis`` and ``low_roas`` are read by several sections, so pass them
    materialised when computing them is expensive.
    """
    parts = [
        headline(kpis),
        _facts(feeds.top_countries(kpis), "top_countries", [F.desc("net_revenue_eur"), F.col("country_code")],
               F.col("country_code"), {"net_revenue_eur": _two("net_revenue_eur")}),
        _facts(feeds.latest_month(kpis), "latest_month", [F.col("country_code")], F.col("country_code"), {
            "net_revenue_eur": _two("net_revenue_eur"), "orders_count": F.col("orders_count"),
            "avg_order_value_eur": _two("avg_order_value_eur"),
            "mom_revenue_growth_pct": _two("mom_revenue_growth_pct")}),
        _facts(feeds.top_return_reasons(returns), "return_reasons",
               [F.desc("returns_count"), F.col("return_reason")], F.col("return_reason"), {
                   "returns_count": F.col("returns_count"), "total_refund_eur": _two("total_refund_eur")}),
        _facts(feeds.top_products(products), "top_products",
               [F.desc_nulls_last("gross_revenue_eur"), F.col("product_id")], F.col("product_name"), {
                   "category": F.col("category"), "gross_revenue_eur": _two("gross_revenue_eur"),
                   "margin_pct": _two("margin_pct"), "return_rate_pct": _two("return_rate_pct")}),
    ]
    if anomalies is not None:
        parts.append(_facts(
            top_anomalies(anomalies), "anomalies", [F.desc(F.abs("seasonal_zscore")), F.col("date")],
            F.col("date").cast("string"), {
                "net_revenue_eur": _two("net_revenue_eur"), "seasonal_zscore": _two("seasonal_zscore"),
                "direction": F.col("direction")}))
    if segments is not None:
        parts.append(_facts(segments, "segments", [F.desc("total_revenue_eur"), F.col("segment")], F.col("segment"), {
            "customers": F.col("customers"), "total_revenue_eur": F.col("total_revenue_eur"),
            "avg_recency_days": F.col("avg_recency_days")}))
    if low_roas is not None:
        count = low_roas.agg(F.count("*").alias("n"))
        parts.append(_facts(count, "marketing", [F.col("n")], F.lit("all"), {"underperforming_count": F.col("n")}))
        where = F.concat_ws(" / ", "country_code", "channel", F.col("month").cast("string"))
        parts.append(_facts(worst_marketing(low_roas), "worst_marketing", list(_WORST), where, {
            "spend_eur": _two("spend_eur"), "blended_roas": _two("blended_roas")}))
    return reduce(DataFrame.unionByName, parts)


def top_anomalies(anomalies: DataFrame, k: int = 5) -> DataFrame:
    """The k days furthest from their baseline, in either direction."""
    return anomalies.orderBy(F.desc(F.abs("seasonal_zscore")), "date").limit(k).select(
        "date", "net_revenue_eur", "seasonal_zscore", "direction")


_WORST = ("z_roas", "country_code", "month", "channel")


def worst_marketing(low_roas: DataFrame, k: int = 3) -> DataFrame:
    return low_roas.orderBy(*_WORST).limit(k)


def evidence_numbers(evidence: DataFrame) -> DataFrame:
    """(section, number): numeric values and the numbers inside entity names and text values."""
    held = F.concat(numbers_in(F.col("value_num"), F.col("value_str")), numbers_in(F.lit(None), F.col("entity")))
    return evidence.select("section", F.explode(held).alias("number"))


def evidence_json(evidence: DataFrame) -> DataFrame:
    """The bounded evidence as one JSON document: section -> [{rank, entity, facts: [{metric, ...}]}]."""
    fact = F.struct("metric", "value_num", "value_str")
    entities = evidence.groupBy("section", "rank", "entity").agg(F.array_sort(F.collect_list(fact)).alias("facts"))
    sections = entities.groupBy("section").agg(
        F.array_sort(F.collect_list(F.struct("rank", "entity", "facts"))).alias("rows"))
    document = F.map_from_entries(F.array_sort(F.collect_list(F.struct("section", "rows"))))
    return sections.agg(F.to_json(document).alias("document"))
