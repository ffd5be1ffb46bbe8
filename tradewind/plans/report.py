"""Narrative and evaluation reports as ordered text lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions.numbers import grouped_number, plain_number

# What each section says, in order: (evidence section, title, figures), a figure being (metric, label, form).
LAYOUT = (
    ("headline", "Totals", (("total_revenue_eur", "net revenue EUR", "whole"), ("total_orders", "orders", "whole"))),
    ("top_countries", "Countries by net revenue", (("net_revenue_eur", "net revenue EUR", "whole"),)),
    ("latest_month", "Month", (
        ("net_revenue_eur", "net revenue EUR", "whole"), ("orders_count", "orders", "whole"),
        ("avg_order_value_eur", "EUR per order", "two"), ("mom_revenue_growth_pct", "change in %", "signed"))),
    ("anomalies", "Days out of line", (
        ("direction", "kind", "text"), ("net_revenue_eur", "net revenue EUR", "whole"), ("seasonal_zscore", "z", "two"))),
    ("segments", "Customer groups", (
        ("customers", "customers", "whole"), ("total_revenue_eur", "revenue EUR", "whole"),
        ("avg_recency_days", "mean days since the last order", "units"))),
    ("top_products", "Products by revenue", (
        ("category", "category", "text"), ("gross_revenue_eur", "revenue EUR", "whole"), ("margin_pct", "margin in %", "one"),
        ("return_rate_pct", "returns in %", "one"))),
    ("return_reasons", "Reasons for returns", (
        ("returns_count", "returns", "whole"), ("total_refund_eur", "refunds EUR", "whole"))),
    ("marketing", "Spend with a low return", (("underperforming_count", "rows of country, channel and month", "whole"),)),
    ("worst_marketing", "Lowest returns on spend", (
        ("spend_eur", "spend EUR", "whole"), ("blended_roas", "revenue per EUR", "two"))),
)
FIRST_LINE = 10  # entity lines follow the title by rank


def _printed(form: str) -> Column:
    v = F.col("value_num")
    return {"whole": grouped_number(v, 0), "units": plain_number(v, 0), "one": plain_number(v, 1), "two": plain_number(v, 2),
            "signed": plain_number(v, 1, sign=True), "text": F.col("value_str")}[form]


def render(evidence: DataFrame) -> DataFrame:
    """(section_no, line_no, line): a title per section that has evidence, then a line per entity.

    Every line is the entity and its figures by LAYOUT, an absent value shown as n/a. Works on the bounded evidence
    rows; numbers are rounded as printf does.
    """
    spec = evidence.sparkSession.createDataFrame(
        [(section, n, title, place, metric, label, form) for n, (section, title, figures) in enumerate(LAYOUT, 1)
         for place, (metric, label, form) in enumerate(figures)],
        "section string, section_no long, title string, place int, metric string, label string, form string")
    shown = F.coalesce(*[F.when(F.col("form") == f, _printed(f)) for f in ("whole", "units", "one", "two", "signed", "text")],
                       F.lit("n/a"))
    figures = evidence.join(spec, ["section", "metric"]).select(
        "section", "section_no", "title", "rank", "entity",
        F.struct("place", F.concat_ws(" ", "label", shown).alias("said")).alias("f"))
    told = F.array_join(F.transform(F.array_sort(F.collect_list("f")), lambda f: f["said"]), ", ")
    body = figures.groupBy("section_no", "rank", "entity").agg(told.alias("told")).select(
        "section_no", (F.col("rank") + FIRST_LINE).alias("line_no"), F.concat_ws(": ", "entity", "told").alias("line"))
    month = evidence.where("metric = 'latest_month'").agg(F.max("value_str")).scalar()
    title = F.when(F.col("section") == "latest_month", F.concat_ws(" ", "title", month)).otherwise(F.col("title"))
    heads = figures.select("section", "section_no", "title").distinct().select(
        "section_no", F.lit(1).cast("long").alias("line_no"), F.concat(F.lit("# "), title).alias("line"))
    return body.unionByName(heads)


def report_text(lines: DataFrame, report_id: str = "report") -> DataFrame:
    """(report_id, text): the few dozen lines of one report as a single text."""
    ordered = F.array_sort(F.collect_list(F.struct("section_no", "line_no", "line")))
    return lines.agg(ordered.alias("_l")).select(
        F.lit(report_id).alias("report_id"),
        F.array_join(F.transform("_l", lambda r: r["line"]), "\n").alias("text"))


def _share(c: str) -> Column:
    return F.concat(F.lit(" ("), plain_number(F.col(c) * 100, 1), F.lit("%)"))


def groundedness_lines(scores: DataFrame, trials: DataFrame, key: str = "report_id") -> DataFrame:
    """(report, line_no, line) of the groundedness evaluation, row-local after one join by report."""
    loose = F.when(F.size("ungrounded") == 0, "none").otherwise(F.array_join("ungrounded", ", "))
    lines = F.array(
        F.concat(F.lit("# "), F.col(key).cast("string")),
        F.concat_ws(" ", F.lit("claims read:"), "numbers_checked"),
        F.concat(F.concat_ws(" ", F.lit("claims backed:"), "grounded"), _share("groundedness_rate")),
        F.concat(F.lit("not backed: "), loose),
        F.concat(F.concat_ws(" ", F.lit("altered figures noticed:"), "caught", F.lit("of"), "trials"), _share("detection_rate")))
    return scores.join(trials, key).select(F.col(key), F.posexplode(lines).alias("line_no", "line"))


def anomaly_eval_lines(scores: DataFrame, sweep: DataFrame, days: DataFrame, incidents: DataFrame) -> DataFrame:
    """(part, line_no, line) of the detector evaluation: what is labelled, a line per detector, a line per threshold."""
    total = days.agg(F.count_distinct("date")).scalar()
    spans = incidents.groupBy("incident").agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    span = F.concat_ws(" ", "incident", F.lit("from"), "lo", F.lit("to"), "hi")
    labelled = incidents.agg(F.count_distinct("date")).scalar()
    labels = spans.agg(F.array_sort(F.collect_list(span)).alias("s")).select(
        F.lit(1).alias("part"), F.lit(0).alias("line_no"),
        F.concat(F.concat_ws(" ", F.lit("days with an incident:"), labelled, F.lit("of"), total, F.lit("- ")),
                 F.array_join("s", "; ")).alias("line"))

    def told(df: DataFrame, part: int, key: str, counts: Sequence[str], shares: Sequence[str], *more: Column) -> DataFrame:
        said = [F.concat_ws(" ", F.lit(c), F.col(c)) for c in counts]
        said += [F.concat(F.lit(c), _share(c)) for c in shares]
        line = F.concat(F.concat_ws(" ", F.lit(key), F.col(key).cast("string")), F.lit(": "), F.concat_ws(", ", *said, *more))
        rows = F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), line.alias("line"))))
        return df.agg(rows.alias("_r")).select(F.posexplode("_r").alias("line_no", "r")).select(
            F.lit(part).alias("part"), "line_no", F.col("r.line").alias("line"))

    return (labels
            .unionByName(told(scores, 2, "detector", ("flagged", "tp", "fp", "fn"), ("precision", "recall", "f1"),
                              F.col("incidents_caught")))
            .unionByName(told(sweep, 3, "threshold", ("flagged", "tp"), ("precision", "recall"))))
