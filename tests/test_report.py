"""The report over one year-end's figures: every printed number, and every number of another wording, is backed."""

import pytest
from pyspark.sql import functions as F

from tradewind.operators import claims, redteam
from tradewind.plans import evidence, report

# Published figures of the retail model.
LATEST = (("DE", 132387.91, 395, 335.16, 32.79), ("ES", 51873.68, 171, 303.35, 17.64), ("FR", 105067.16, 319, 329.36, 33.86),
          ("GB", 105518.6, 371, 284.42, 24.33), ("IT", 37115.85, 125, 296.93, 22.36), ("NL", 57073.37, 174, 328.01, 27.3),
          ("SE", 17712.65, 63, 281.15, -38.02))
COUNTRIES = (("DE", 1591653.93), ("FR", 1243979.1), ("GB", 1225857.98))
REASONS = (("wrong_size", 245, 55841.14), ("late_delivery", 239, 47419.36), ("not_as_described", 238, 54748.27))
PRODUCTS = (("Electronics Item 129", 209240.99, 51.45, 4.95), ("Electronics Item 144", 187524.96, 47.69, 10.33),
            ("Electronics Item 112", 187269.39, 40.7, 8.79), ("Electronics Item 75", 186252.42, 41.61, 5.83),
            ("Electronics Item 55", 184940.7, 47.69, 5.14))
ANOMALIES = (("2025-03-03", 27139.28, 10.57), ("2025-03-04", 27878.79, 9.55), ("2025-09-05", 14752.3, 8.3),
             ("2025-05-13", 11400.0, 7.71), ("2024-11-27", 16567.71, 5.83))
SEGMENTS = (("Champions", 679, 1949237.5, 20.7), ("Potential Loyalist", 1130, 1419181.2, 41.3), ("At Risk", 701, 1321348.2, 173.3),
            ("Hibernating", 891, 784085.0, 259.6), ("Loyal", 580, 767453.6, 18.7))
WORST = (("SE / paid_search / 2025-08-01", 1174.52, 5.61), ("SE / affiliate / 2025-08-01", 467.63, 14.08),
         ("NL / social_media / 2024-02-01", 1835.51, 7.22))


def rows(section, table, *metrics):
    return [(section, i, r[0], m, float(v), None) for i, r in enumerate(table, 1) for m, v in zip(metrics, r[1:])]


@pytest.fixture(scope="module")
def facts(spark):
    found = [("headline", 1, "all", "latest_month", None, "2025-12-01"), ("headline", 1, "all", "total_revenue_eur", 6241305.43, None),
             ("headline", 1, "all", "total_orders", 20225.0, None), ("marketing", 1, "all", "underperforming_count", 35.0, None)]
    found += rows("top_countries", COUNTRIES, "net_revenue_eur")
    found += rows("latest_month", LATEST, "net_revenue_eur", "orders_count", "avg_order_value_eur", "mom_revenue_growth_pct")
    found += rows("return_reasons", REASONS, "returns_count", "total_refund_eur")
    found += rows("top_products", PRODUCTS, "gross_revenue_eur", "margin_pct", "return_rate_pct")
    found += [("top_products", i, p[0], "category", None, "Electronics") for i, p in enumerate(PRODUCTS, 1)]
    found += rows("anomalies", ANOMALIES, "net_revenue_eur", "seasonal_zscore")
    found += [("anomalies", i, a[0], "direction", None, "spike") for i, a in enumerate(ANOMALIES, 1)]
    found += rows("segments", SEGMENTS, "customers", "total_revenue_eur", "avg_recency_days")
    found += rows("worst_marketing", WORST, "spend_eur", "blended_roas")
    return spark.createDataFrame(found, "section string, rank bigint, entity string, metric string, value_num double, value_str string")


def test_lines(facts):
    lines = [r.line for r in report.render(facts).orderBy("section_no", "line_no").collect()]
    for line in (
        "all: net revenue EUR 6,241,305, orders 20,225",
        "FR: net revenue EUR 1,243,979",
        "# Month 2025-12-01",
        "SE: net revenue EUR 17,713, orders 63, EUR per order 281.15, change in % -38.0",
        "2025-05-13: kind spike, net revenue EUR 11,400, z 7.71",
        "Champions: customers 679, revenue EUR 1,949,238, mean days since the last order 21",
        "Electronics Item 129: category Electronics, revenue EUR 209,241, margin in % 51.5, returns in % 5.0",
        "late_delivery: returns 239, refunds EUR 47,419",
        "NL / social_media / 2024-02-01: spend EUR 1,836, revenue per EUR 7.22",
    ):
        assert line in lines
    assert [x for x in lines if x.startswith("# ")] == [
        "# Totals", "# Countries by net revenue", "# Month 2025-12-01", "# Days out of line", "# Customer groups",
        "# Products by revenue", "# Reasons for returns", "# Spend with a low return", "# Lowest returns on spend"]


def test_all_claims_are_backed_and_alterations_noticed(facts):
    text = report.report_text(report.render(facts))
    pool = claims.pool_array(evidence.evidence_numbers(facts))
    score = claims.score_texts(text, "report_id", "text", pool).first()
    assert (score.numbers_checked, score.grounded, score.ungrounded, score.groundedness_rate) == (91, 91, [], 1.0)
    for dates in (False, True):
        team = redteam.red_team(text, "report_id", "text", pool, include_dates=dates).first()
        assert team.trials == 200 and 0.75 < team.detection_rate < 1.0


def test_a_wrong_figure_stands_out(facts):
    text = report.report_text(report.render(facts)).withColumn("text", F.replace("text", F.lit("1,591,654"), F.lit("1,691,654")))
    pool = claims.pool_array(evidence.evidence_numbers(facts))
    assert claims.score_texts(text, "report_id", "text", pool).first().ungrounded == ["1,691,654"]
    lines = report.groundedness_lines(claims.score_texts(text, "report_id", "text", pool),
                                      redteam.red_team(text, "report_id", "text", pool, trials=5))
    got = [r.line for r in lines.orderBy("line_no").collect()]
    assert got[1:] == ["claims read: 91", "claims backed: 90 (98.9%)", "not backed: 1,691,654",
                       "altered figures noticed: 5 of 5 (100.0%)"]
