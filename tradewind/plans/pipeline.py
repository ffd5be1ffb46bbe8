"""The full batch: clean, load, model, test, analyse, report, export."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind import sinks
from tradewind.operators import claims, redteam
from tradewind.operators import quality as q
from tradewind.operators.scoring import incident_days, score_detectors, sweep_thresholds
from tradewind.plans import audit, evidence, feeds, report
from tradewind.plans.model import ALL, EXPORTED, SORTED, Model
from tradewind.scale import materialize
from tradewind.sources.fx_payload import require_rates
from tradewind.sources.schemas import CATEGORIES, COUNTRY_CODES, ORDER_STATUSES, RAW_SCHEMAS
from tradewind.sources.warehouse import load_tables, read_tables
from tradewind.store import shared


KEYS = (("stg_customers", "customer_id"), ("stg_products", "product_id"), ("stg_orders", "order_id"),
        ("dim_country", "country_code"), ("dim_customer", "customer_id"), ("dim_product", "product_id"),
        ("dim_date", "date_day"), ("fct_orders", "order_id"), ("fct_returns", "return_id"))
LINKS = (("dim_customer", "country_code", "dim_country", "country_code"),
         ("fct_orders", "customer_id", "dim_customer", "customer_id"),
         ("fct_returns", "order_id", "fct_orders", "order_id"),
         ("fct_marketing_spend", "country_code", "dim_country", "country_code"))


def tested_table(m: Model) -> Callable[[str], DataFrame]:
    """Tables as built, staged ones by their prefix."""
    return lambda name: m.staged(name[4:]) if name.startswith("stg_") else m.table(name)


def data_tests(statuses: Sequence[str] = ORDER_STATUSES) -> list[q.Test]:
    """The model's declared tests on the tables they name: nine unique and non-null keys, four relationships, one value list."""
    keys = [q.Test(kind, t, k) for kind in ("unique", "not_null") for t, k in KEYS]
    links = [q.Test("relationships", t, c, (parent, k)) for t, c, parent, k in LINKS]
    return [*keys, *links, q.Test("accepted_values", "fct_orders", "status", values=tuple(statuses))]


def integrity_tests() -> list[q.Test]:
    """Warehouse checks: duplicate orders, negative revenue, orders without a known customer."""
    return [q.Test("no_duplicates", "fct_orders", "order_id"), q.Test("not_negative", "fct_orders", "net_amount_eur"),
            q.Test("no_orphans", "fct_orders", "customer_id", ("dim_customer", "customer_id"))]


def gather_evidence(m: Model) -> DataFrame:
    """The evidence rows, with the marts several sections read written once (all bounded by dimensions)."""
    kpis = materialize(m.monthly_revenue_kpis, "kpis")
    low = materialize(m.low_roas, "low_roas")
    return evidence.gather(kpis, m.returns_analysis, m.product_performance, m.revenue_anomalies, m.rfm_summary, low)


def shared_evidence(m: Model) -> DataFrame:
    """``gather_evidence`` once per state of the raw extracts and the model's parameters."""
    return shared("evidence", [m.raw(name) for name in (*RAW_SCHEMAS, "country")], lambda: gather_evidence(m), *m.parameters)


def run(spark: SparkSession, read: Callable[[str], DataFrame], out: str, incidents: Sequence[tuple[str, str, str]] = (),
        countries: Sequence[str] = COUNTRY_CODES, categories: Sequence[str] = CATEGORIES,
        database: str = "raw", buckets: int | None = None) -> dict[str, int]:
    """Run every stage and write the results under ``out``; returns exported row counts.

    Clean tables are loaded once; everything after reads those tables. ``buckets``
    clusters the order-grain tables on order_id, which spares their joins the
    exchange but pins each order to one file: leave it unset when one order_id
    may be hot, so that AQE can split it. The data-test report is written before
    a failure is raised by the caller's own policy.
    """
    source = Model(read, countries, categories)
    cleaned = {name: source.clean(name) for name in RAW_SCHEMAS}
    cleaned["exchange_rates"] = require_rates(cleaned["exchange_rates"])
    load_tables(cleaned, database, buckets)
    sinks.write_lines(audit.dq_lines(audit.dq_report({n: read(n) for n in RAW_SCHEMAS}, countries)),
                      f"{out}/data_quality_report", ["table_name", "rule"])
    loaded = read_tables(spark, list(RAW_SCHEMAS), database)

    class Loaded(Model):
        def clean(self, name: str) -> DataFrame:
            return loaded[name]

        def _lookup(self, name: str) -> DataFrame:
            return self.staged(name)  # stored already

    m = Loaded(read, countries, categories)
    sinks.write_csv(q.run_tests(tested_table(m), data_tests() + integrity_tests()), f"{out}/data_tests")
    flags = materialize(m.weekday_flags, "flags")
    by_country = materialize(m.stl_flags, "stl")
    stl = by_country.where(F.col("country_code") == ALL)
    counts = sinks.export_csv({name: m.table(name) for name in EXPORTED}, f"{out}/exports", SORTED)
    joined = flags.join(stl.select("date", "poisson_z", "stl_poisson_anomaly"), "date", "left")
    counts |= sinks.export_csv({
        "revenue_anomalies": flags.where("is_anomaly"), "daily_revenue_with_flags": joined,
        "customer_rfm_segments": m.rfm_segments, "rfm_segment_summary": m.rfm_summary,
        "underperforming_marketing_spend": m.low_roas}, f"{out}/analysis", SORTED)
    kpis, returns = materialize(m.monthly_revenue_kpis, "kpis"), materialize(m.returns_analysis, "returns")
    counts |= sinks.export_csv({
        "headline_kpis": feeds.headline_kpis(m.staged("orders"), m.staged("customers")),
        "monthly_total": feeds.monthly_total(kpis), "revenue_by_country": feeds.revenue_by_country(kpis),
        "top_countries": feeds.top_countries(kpis), "latest_month": feeds.latest_month(kpis),
        "returns_by_reason": feeds.returns_by_reason(returns), "top_return_reasons": feeds.top_return_reasons(returns),
        "top_products": feeds.top_products(m.product_performance), "channel_cpc": feeds.channel_cpc(m.marketing_roi),
        "segment_caption": feeds.segment_caption(m.rfm_summary),
        # the decomposition's flag where there is one, as the dashboard shows it
        "anomaly_feed": feeds.anomaly_feed(joined, "stl_poisson_anomaly", "poisson_z"),
        "data_quality": feeds.dq_feed(audit.dq_messages(audit.dq_report({n: read(n) for n in RAW_SCHEMAS}, countries)))},
        f"{out}/feeds", SORTED)

    facts = materialize(gather_evidence(m), "evidence")
    sinks.write_document(evidence.evidence_json(facts), f"{out}/evidence")
    lines = report.render(facts)
    sinks.write_lines(lines, f"{out}/report", ["section_no", "line_no"])
    text = materialize(report.report_text(lines), "report")
    numbers = evidence.evidence_numbers(facts)
    sinks.write_lines(report.groundedness_lines(
        claims.score_against_pool(text, "report_id", "text", numbers),
        redteam.red_team_against_pool(text, "report_id", "text", numbers)),
        f"{out}/groundedness", ["report_id", "line_no"])
    if incidents:
        truth = incident_days(spark, incidents)
        both = flags.selectExpr("'weekday baseline' as detector", "date", "is_anomaly as flagged").unionByName(
            stl.selectExpr("'seasonal decomposition' as detector", "date", "stl_poisson_anomaly as flagged"))
        sinks.write_lines(report.anomaly_eval_lines(
            score_detectors(both, truth), sweep_thresholds(stl, truth, "raw_z"), stl, truth),
            f"{out}/anomaly_eval", ["part", "line_no"])
    return counts
