"""Recency, frequency and monetary scoring of customers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.numbers import round_to
from tradewind.operators.quantiles import exact_quantiles, right_closed_bin
from tradewind.operators.ranking import global_row_number
from tradewind.scale import materialize

# Inner quintile probabilities as k steps of 0.2.
QUINTILES = tuple(k * 0.2 for k in range(1, 5))


def rfm_scores(ltv: DataFrame) -> DataFrame:
    """Quintile scores 1-5 per customer with at least one order.

    The purchasers are written once, narrow, because five steps read them.
    Recency edges come from a day histogram (bounded by the calendar), monetary
    edges from the exact quantiles, and the frequency rank, ties by
    customer id, from the range-partitioned global row number.
    """
    buyers = materialize(
        ltv.where("total_orders > 0").select(
            "customer_id", "country_code", "first_order_date", "last_order_date", F.col("total_orders").alias("frequency"),
            F.col("total_net_revenue_eur").cast("double").alias("monetary")),
        "buyers")
    as_of = buyers.agg(F.max("last_order_date")).scalar()
    idle = F.date_diff(as_of, F.col("last_order_date")).cast("long")
    probs = F.array(*[F.lit(p) for p in QUINTILES])
    by_age = buyers.groupBy(idle.alias("idle")).agg(F.count("*").alias("n"))
    # one row: customers, recency edges and monetary edges
    edges = materialize(
        by_age.agg(F.sum("n").alias("n"), F.percentile("idle", probs, F.col("n")).alias("recency")).withColumn(
            "money", exact_quantiles(buyers, "monetary", QUINTILES).select("q").scalar()), "edges")

    def edge(c: str) -> Column:
        return edges.select(c).scalar()

    ranked = global_row_number(buyers.withColumn("recency_days", idle), ["frequency", "customer_id"], "_rank")
    rank_edges = F.array(*[F.lit(1.0) + (edge("n") - 1) * F.lit(p) for p in QUINTILES])
    scored = (
        ranked.withColumns({"_re": edge("recency"), "_me": edge("money"), "_fe": rank_edges})
        .withColumns({"r_score": F.lit(6) - right_closed_bin(F.col("recency_days"), F.col("_re")),
                      "f_score": right_closed_bin(F.col("_rank"), F.col("_fe")),
                      "m_score": right_closed_bin(F.col("monetary"), F.col("_me"))}))
    return scored.select(
        "customer_id", "country_code", "first_order_date", "last_order_date", "recency_days", "frequency", "monetary",
        "r_score", "f_score", "m_score", (F.col("r_score") + F.col("f_score") + F.col("m_score")).alias("rfm_score"))


def rfm_segments(scores: DataFrame) -> DataFrame:
    """Name the segment; the first rule that holds wins."""
    total, r, f = F.col("rfm_score"), F.col("r_score"), F.col("f_score")
    segment = (F.when(total >= 13, "Champions")
               .when((r >= 4) & (f >= 3), "Loyal")
               .when((r <= 2) & (f >= 3), "At Risk")
               .when((r <= 2) & (f <= 2), "Hibernating")
               .otherwise("Potential Loyalist"))
    return scores.withColumn("segment", segment)


def rfm_summary(segments: DataFrame) -> DataFrame:
    """Size, revenue and mean recency per segment, largest revenue first."""
    money = F.sum(F.col("monetary").cast("decimal(38,2)")).cast("double")
    return segments.groupBy("segment").agg(
        F.count("customer_id").alias("customers"),
        round_to(money, 1).alias("total_revenue_eur"),
        round_to(F.avg("recency_days"), 1).alias("avg_recency_days"),
    ).orderBy(F.desc("total_revenue_eur"), "segment")
