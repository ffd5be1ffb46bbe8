"""Empty inputs, documents read back, and rate payloads without rates."""

from pyspark.sql import functions as F

from tradewind.operators.scoring import incident_days, score_detectors
from tradewind.plans import evidence, report
from tradewind.plans.model import EXPORTED, Model
from tradewind.sources.schemas import ORDERED_EXTRACTS, RAW_SCHEMAS
from tradewind.sources.seeds import country_seed


def test_no_rows_in_gives_no_rows_out(spark):
    def read(name):
        if name == "country":
            return country_seed(spark)
        order = ", ingest_seq bigint" if name in ORDERED_EXTRACTS else ""
        return spark.createDataFrame([], RAW_SCHEMAS[name] + order)

    m = Model(read)
    for name in EXPORTED:
        assert m.table(name).count() == (7 if name == "dim_country" else 0), name
    for name in ("weekday_flags", "stl_flags", "rfm_summary", "low_roas", "product_performance_nofanout"):
        assert m.table(name).count() == 0, name
    facts = evidence.gather(m.monthly_revenue_kpis, m.returns_analysis, m.product_performance)
    assert {r.section for r in facts.collect()} == {"headline"}
    truth = incident_days(spark, [("A", "2024-01-01", "2024-01-02")])
    none = m.weekday_flags.select(F.lit("d").alias("detector"), "date", F.col("is_anomaly").alias("flagged"))
    assert score_detectors(none, truth).count() == 0


def test_optional_sections_are_left_out(spark):
    rows = [("headline", 1, "all", "total_revenue_eur", 1234567.5, None), ("headline", 1, "all", "total_orders", 12.0, None),
            ("top_countries", 1, "DE", "net_revenue_eur", 900.4, None), ("top_countries", 2, "FR", "net_revenue_eur", 300.5, None)]
    facts = spark.createDataFrame(rows, "section string, rank bigint, entity string, metric string, value_num double, value_str string")
    lines = [r.line for r in report.render(facts).orderBy("section_no", "line_no").collect()]
    assert lines == ["# Totals", "all: net revenue EUR 1,234,568, orders 12", "# Countries by net revenue",
                     "DE: net revenue EUR 900", "FR: net revenue EUR 300"]


def test_json_document_holds_the_same_facts(spark):
    rows = [("a", 1, "x", "m", 1.25, None), ("a", 1, "x", "k", None, "t"), ("a", 2, "y", "m", -3.0, None), ("b", 1, "z", "m", None, None)]
    facts = spark.createDataFrame(rows, "section string, rank bigint, entity string, metric string, value_num double, value_str string")
    kind = ("map<string, array<struct<rank: bigint, entity: string, facts: array<struct<metric: string, value_num: double, "
            "value_str: string>>>>>")
    back = (evidence.evidence_json(facts).select(F.explode(F.from_json("document", kind)).alias("section", "rows"))
            .select("section", F.inline("rows")).select("section", "rank", "entity", F.inline("facts")))
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)
