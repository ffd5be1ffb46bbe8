"""Every query by name: a function of (spark, directory of the input tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind import sinks
from tradewind.functions.dates import mixed_date
from tradewind.functions.numbers import round_to
from tradewind.functions.text import canonical, normalize_code, within_domain
from tradewind.operators import calendar, claims, dedupe, redteam
from tradewind.operators import quality as q
from tradewind.operators.anomaly import iqr_fence, weekday_baseline
from tradewind.operators.calendar import fill_days
from tradewind.operators.scoring import incident_days, score_detectors, sweep_thresholds
from tradewind.operators.stl import poisson_residuals
from tradewind.plans import audit, clean, evidence, feeds, marts, measures, pipeline, report
from tradewind.plans.model import ALL, EXPORTED, Model
from tradewind.plans.staging import stage
from tradewind.scale import materialize, scratch_path
from tradewind.session import apply_conf
from tradewind.sources import adapter, csv, fx_payload, schemas, warehouse

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Widen result types to double and bigint so engines agree on them."""
    wide = {T.DecimalType: "double", T.FloatType: "double", T.IntegerType: "bigint", T.ShortType: "bigint"}
    return df.select(*[
        F.col(f"`{f.name}`").cast(wide[type(f.dataType)]).alias(f.name) if type(f.dataType) in wide
        else F.col(f"`{f.name}`") for f in df.schema])


def model(spark: SparkSession, sf_dir: str, hold: tuple[str, ...] = ()) -> Model:
    return Model(adapter.extract_reader(apply_conf(spark), sf_dir), adapter.VALID_CODES, adapter.CATEGORY_NAMES, hold)


def query(name: str, *hold: str):
    """Register a function of the model under ``name``; ``hold`` lists staged tables it reads repeatedly."""

    def register(fn: Callable[[Model], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: plain(fn(model(spark, sf_dir, hold)))
        return fn

    return register


def texts(m: Model) -> DataFrame:
    return m.raw("documents")


# --- sources and sinks -------------------------------------------------------------------------


@query("scan_csv_roundtrip")
def _(m):
    raw = m.raw("products")
    spark = raw.sparkSession
    path = scratch_path(spark, "products_csv")
    csv.write_csv(raw, path)
    return csv.read_extract(spark, path, "products")


@query("scan_csv_reordered")
def _(m):
    """The same extract with its columns in another order: cells follow the header."""
    raw = m.raw("products")
    spark = raw.sparkSession
    path = scratch_path(spark, "products_csv")
    csv.write_csv(raw.select(*reversed(raw.columns)), path)
    return csv.read_extract(spark, path, "products")


@query("scan_csv_rejects")
def _(m):
    """Amounts too wide for their type are counted, not lost."""
    raw = m.raw("orders")
    spark = raw.sparkSession
    path = scratch_path(spark, "orders_csv")
    wide = F.when(F.col("ingest_seq") % 50 == 0, "98765432109876.54").otherwise(F.col("net_amount_eur").cast("string"))
    csv.write_csv(raw.withColumn("net_amount_eur", wide).drop("ingest_seq"), path)
    return csv.count_rejects(spark, path, schemas.RAW_SCHEMAS["orders"], "orders")


@query("scan_csv_quarantine")
def _(m):
    """Records kept, and quarantined ones by column and reason: the same planted amounts, each record in one place."""
    raw = m.raw("orders")
    spark = raw.sparkSession
    path = scratch_path(spark, "orders_csv")
    wide = F.when(F.col("ingest_seq") % 50 == 0, "98765432109876.54").otherwise(F.col("net_amount_eur").cast("string"))
    csv.write_csv(raw.withColumn("net_amount_eur", wide).drop("ingest_seq"), path)
    kept, lost = csv.read_or_quarantine(spark, path, schemas.RAW_SCHEMAS["orders"])
    one = kept.agg(F.count("*").alias("records"), F.sum("net_amount_eur").cast("double").alias("net_amount_eur")).select(
        F.lit("").alias("column_name"), F.lit("kept").alias("reason"), "records", "net_amount_eur")
    places = F.count_distinct("file", "block", "row").alias("records")
    return one.unionByName(lost.groupBy("column_name", "reason").agg(places).withColumn("net_amount_eur", F.lit(None).cast("double")))


@query("load_counts")
def _(m):
    """Create or replace one table per clean extract, then count what was stored, in a database of this call's own."""
    spark = m.raw("orders").sparkSession
    path = scratch_path(spark, "warehouse")
    database = path.rsplit("/", 1)[1].replace("-", "_")
    warehouse.load_tables({n: m.clean(n) for n in schemas.RAW_SCHEMAS}, database, location=path)
    counts = materialize(warehouse.count_rows(warehouse.read_tables(spark, list(schemas.RAW_SCHEMAS), database)), "counts")
    spark.sql(f"drop database {database} cascade")
    return counts


@query("export_counts", "orders", "order_items", "customers", "products", "returns", "marketing_spend")
def _(m):
    """Write the fourteen exports as CSV; rows are counted while they are written."""
    spark = m.raw("orders").sparkSession
    m.prepare()
    counts = sinks.export_csv({n: m.table(n) for n in EXPORTED}, scratch_path(spark, "exports"))
    return spark.createDataFrame(sorted(counts.items()), "table_name string, row_count bigint")


@query("fx_flatten")
def _(m):
    rates = m.raw("exchange_rates")
    # one payload per month, as a rate service would answer for that range
    rates = rates.groupBy("date", "currency_code").agg(F.max("rate_to_eur").alias("rate_to_eur"))
    day = rates.groupBy("date").agg(F.map_from_entries(F.collect_list(
        F.struct("currency_code", F.col("rate_to_eur").cast("double")))).alias("r"))
    month = day.groupBy(F.substring("date", 1, 7).alias("m")).agg(
        F.map_from_entries(F.collect_list(F.struct("date", "r"))).alias("rates"))
    return fx_payload.flatten_rates(month.select(F.to_json(F.struct("rates")).alias("payload")), ("GBP", "SEK"))


@query("evidence_json", "orders")
def _(m):
    return evidence.evidence_json(pipeline.gather_evidence(m))


@query("dq_report")
def _(m):
    return audit.dq_report({n: m.raw(n) for n in schemas.RAW_SCHEMAS}, adapter.VALID_CODES)


@query("dq_feed")
def _(m):
    return feeds.dq_feed(audit.dq_messages(
        audit.dq_report({n: m.raw(n) for n in schemas.RAW_SCHEMAS}, adapter.VALID_CODES)))


# --- cleaning ----------------------------------------------------------------------------------


@query("dedupe_customers")
def _(m):
    return dedupe.keep_first(m.raw("customers"), ["customer_id"], clean.ORDER_KEY).select("customer_id", "ingest_seq", "city")


@query("dedupe_orders")
def _(m):
    return dedupe.keep_first(m.raw("orders"), ["order_id"], clean.ORDER_KEY).select("order_id", "ingest_seq")


@query("dedupe_payments")
def _(m):
    return clean.clean_payments(m.raw("payments"))


@query("dedupe_items")
def _(m):
    return dedupe.distinct_rows(m.raw("order_items"))


@query("normalize_country")
def _(m):
    return m.raw("orders").select("ingest_seq", normalize_code(F.col("country_code")).alias("country_code"))


@query("country_domain_check")
def _(m):
    code = within_domain(normalize_code(F.col("country_code")), adapter.VALID_CODES, clean.UNKNOWN_COUNTRY)
    return m.raw("customers").groupBy(code.alias("country_code")).agg(F.count("*").alias("customers"))


@query("canonical_category")
def _(m):
    return m.raw("products").select("product_id", canonical(
        F.col("category"), adapter.CATEGORY_NAMES, clean.UNKNOWN_CATEGORY).alias("category"))


@query("parse_mixed_date")
def _(m):
    return m.raw("orders").select("ingest_seq", mixed_date(F.col("order_date")).alias("order_date")).unionByName(
        m.raw("returns").select(F.expr("cast(substr(return_id, 2) as bigint)").alias("ingest_seq"),
                                mixed_date(F.col("return_date")).alias("order_date")))


@query("nonstandard_date_counts")
def _(m):
    return audit.nonstandard_dates(m.raw("orders"), m.raw("returns"))


@query("null_audit")
def _(m):
    return audit.null_audit(m.raw("customers"), ["email", "birth_date"], "customers").unionByName(
        audit.null_audit(m.raw("returns"), ["return_reason"], "returns"))


@query("impute_cost")
def _(m):
    filled = m.clean("products").select("product_id", "category", "unit_price_eur", "unit_cost_eur")
    missing = m.raw("products").where("unit_cost_eur is null").select("product_id")
    return filled.join(missing, "product_id", "left_semi")


@query("fix_negative_amounts")
def _(m):
    return m.clean("orders").where("data_quality_flag is not null").select(
        "order_id", "net_amount_eur", "gross_amount_eur", "data_quality_flag")


@query("fill_return_reason")
def _(m):
    return m.clean("returns").groupBy("return_reason").agg(F.count("*").alias("rows"))


@query("clip_spend")
def _(m):
    return m.clean("marketing_spend").where("spend_eur <= 0").select("date", "country_code", "channel", "spend_eur")


@query("fx_add_base")
def _(m):
    return clean.add_base_rates(m.raw("exchange_rates"))


@query("fx_fill_calendar")
def _(m):
    rates = materialize(m.raw("exchange_rates").withColumn("date", F.col("date").cast("date")), "rates")
    edges = rates.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    start, end = (F.date_add(edges.select(c).scalar(), d) for c, d in (("lo", -3), ("hi", 3)))
    return calendar.fill_forward_then_back(rates, start, end)


for _name, _table in {
    "clean_customers": "customers", "clean_products": "products", "clean_orders": "orders",
    "clean_items": "order_items", "clean_payments": "payments", "clean_returns": "returns",
    "clean_spend": "marketing_spend", "clean_fx": "exchange_rates",
}.items():
    query(_name)(lambda m, t=_table: m.clean(t))

for _table in schemas.RAW_SCHEMAS:
    query(f"stg_{_table}")(lambda m, t=_table: m.staged(t))


@query("typed_completed_orders")
def _(m):
    """Header CSV in, typed columns, completed orders out."""
    orders = m.clean("orders")
    spark = orders.sparkSession
    path = scratch_path(spark, "orders_csv")
    csv.write_csv(orders, path)
    typed = csv.read_csv(spark, path, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in orders.schema))
    return marts.completed(stage(typed, "orders"))


# --- dimensions, facts, marts ------------------------------------------------------------------

for _name in ("dim_country", "dim_customer", "dim_product", "dim_date", "fct_orders", "fct_order_items",
              "fct_returns", "fct_marketing_spend", "monthly_revenue_kpis", "customer_ltv", "cohort_retention",
              "product_performance", "product_performance_nofanout", "marketing_roi", "returns_analysis",
              "daily_revenue"):
    query(_name)(lambda m, t=_name: m.table(t))


@query("revenue_by_country")
def _(m):
    return feeds.revenue_by_country(m.monthly_revenue_kpis)


@query("top_countries")
def _(m):
    return feeds.top_countries(m.monthly_revenue_kpis)


@query("latest_month_snapshot")
def _(m):
    return feeds.latest_month(materialize(m.monthly_revenue_kpis, "kpis"))


@query("top_return_reasons")
def _(m):
    return feeds.top_return_reasons(m.returns_analysis)


@query("top_products")
def _(m):
    return feeds.top_products(m.product_performance)


@query("monthly_total")
def _(m):
    return feeds.monthly_total(m.monthly_revenue_kpis)


@query("channel_cpc")
def _(m):
    return feeds.channel_cpc(m.marketing_roi)


@query("returns_by_reason")
def _(m):
    return feeds.returns_by_reason(m.returns_analysis)


@query("headline_kpis")
def _(m):
    return feeds.headline_kpis(m.staged("orders"), m.staged("customers"))


# --- statistics --------------------------------------------------------------------------------


def _rounded(df: DataFrame, places: int, *cols: str) -> DataFrame:
    return df.select(*[round_to(F.col(c), places).alias(c) if c in cols else F.col(c) for c in df.columns])


@query("weekday_anomalies")
def _(m):
    return _rounded(m.weekday_flags, 4, "seasonal_baseline", "residual", "seasonal_zscore")


@query("iqr_outliers")
def _(m):
    return _rounded(iqr_fence(m.dense_daily).where("iqr_anomaly"), 4, "q1", "q3")


@query("top_anomalies")
def _(m):
    return _rounded(evidence.top_anomalies(m.revenue_anomalies), 4, "seasonal_zscore")


@query("anomaly_feed")
def _(m):
    return _rounded(feeds.anomaly_feed(materialize(m.weekday_flags, "flags")), 4, "z")


@query("stl_poisson")
def _(m):
    return m.stl_flags


@query("stl_anomaly_feed")
def _(m):
    return feeds.anomaly_feed(materialize(m.stl_flags.where(F.col("country_code") == ALL), "stl"), "stl_poisson_anomaly", "poisson_z")


@query("rfm_scores")
def _(m):
    return m.rfm_scores


@query("rfm_segments")
def _(m):
    return m.rfm_segments.select("customer_id", "rfm_score", "segment")


@query("rfm_summary")
def _(m):
    return m.rfm_summary


@query("rfm_caption")
def _(m):
    return feeds.segment_caption(m.rfm_summary)


@query("roas_zscores")
def _(m):
    return _rounded(m.roas_zscores, 6, "z_roas")


@query("low_roas_scan")
def _(m):
    return _rounded(m.low_roas, 6, "z_roas")


@query("worst_marketing")
def _(m):
    return _rounded(evidence.worst_marketing(m.low_roas), 6, "z_roas")


def _incident_days(m: Model) -> DataFrame:
    """Dense daily series of the orders with planted incidents."""
    daily = marts.daily_revenue(stage(clean.clean_orders(m.raw("incident_orders")), "orders"))
    return fill_days(materialize(daily, "incident_daily"), ["net_revenue_eur", "orders_count"])


def _baseline_days(m: Model) -> DataFrame:
    return weekday_baseline(_incident_days(m)).select(
        F.lit("weekday baseline").alias("detector"), "date", F.col("is_anomaly").alias("flagged"),
        F.col("seasonal_zscore").alias("z"))


def _stl_days(m: Model) -> DataFrame:
    return poisson_residuals(_incident_days(m)).select(
        F.lit("seasonal decomposition").alias("detector"), "date", F.col("stl_poisson_anomaly").alias("flagged"),
        F.col("raw_z").alias("z"))


def _truth(df: DataFrame) -> DataFrame:
    return incident_days(df.sparkSession, adapter.INCIDENTS)


@query("detector_scores")
def _(m):
    days = _baseline_days(m)
    return score_detectors(days, _truth(days))


@query("threshold_sweep")
def _(m):
    days = _baseline_days(m)
    return sweep_thresholds(days, _truth(days), "z")


@query("detector_scores_stl")
def _(m):
    days = _stl_days(m)
    return score_detectors(days, _truth(days))


@query("threshold_sweep_stl")
def _(m):
    days = _stl_days(m)
    return sweep_thresholds(days, _truth(days), "z")


@query("anomaly_eval_lines")
def _(m):
    stl = materialize(_stl_days(m), "stl_days")
    both = _baseline_days(m).unionByName(stl)
    truth = _truth(stl)
    return report.anomaly_eval_lines(score_detectors(both, truth), sweep_thresholds(stl, truth, "z"), stl, truth)


# --- evidence, report, groundedness ------------------------------------------------------------


def _evidence(m: Model) -> DataFrame:
    """The evidence rows, built once per state of the extracts: every query that checks texts against them shares them."""
    return pipeline.shared_evidence(m)


@query("evidence", "orders")
def _(m):
    return pipeline.gather_evidence(m)


@query("report_lines", "orders")
def _(m):
    return report.render(_evidence(m))


@query("extract_claims")
def _(m):
    return claims.explode_claims(texts(m), "doc_id", "text")


@query("evidence_numbers", "orders")
def _(m):
    return evidence.evidence_numbers(_evidence(m))


@query("grounded_claims", "orders")
def _(m):
    numbers = evidence.evidence_numbers(_evidence(m))
    found = materialize(claims.explode_claims(texts(m), "doc_id", "text"), "claims")
    return claims.ground_against_pool(found, numbers)


@query("grounded_claims_large_pool")
def _(m):
    """Claims of every document against all product prices and order amounts."""
    numbers = m.raw("products").select(F.col("unit_price_eur").cast("double").alias("number")).unionByName(
        m.raw("orders").select(F.col("net_amount_eur").cast("double").alias("number")))
    found = materialize(claims.explode_claims(texts(m), "doc_id", "text"), "claims")
    return claims.ground_against_pool(found, numbers)


@query("groundedness_score", "orders")
def _(m):
    scored = claims.score_against_pool(texts(m), "doc_id", "text", evidence.evidence_numbers(_evidence(m)))
    return scored.withColumn("ungrounded", F.array_join("ungrounded", " "))


@query("report_groundedness", "orders")
def _(m):
    facts = _evidence(m)
    text = report.report_text(report.render(facts))
    scored = claims.score_texts(text, "report_id", "text", claims.pool_array(evidence.evidence_numbers(facts)))
    return scored.withColumn("ungrounded", F.array_join("ungrounded", " "))


@query("red_team_rate", "orders")
def _(m):
    return redteam.red_team_against_pool(texts(m), "doc_id", "text", evidence.evidence_numbers(_evidence(m)))


@query("red_team_report", "orders")
def _(m):
    facts = _evidence(m)
    pool = claims.pool_array(evidence.evidence_numbers(facts))
    return redteam.red_team(report.report_text(report.render(facts)), "report_id", "text", pool, include_dates=False)


@query("red_team_report_with_dates", "orders")
def _(m):
    facts = _evidence(m)
    return redteam.red_team_against_pool(report.report_text(report.render(facts)), "report_id", "text", evidence.evidence_numbers(facts))


@query("groundedness_lines", "orders")
def _(m):
    facts = _evidence(m)
    text = report.report_text(report.render(facts))
    corpus = texts(m).select(F.concat(F.lit("document "), F.col("doc_id")).alias("report_id"), "text").unionByName(text)
    numbers = evidence.evidence_numbers(facts)
    return report.groundedness_lines(claims.score_against_pool(corpus, "report_id", "text", numbers),
                                     redteam.red_team_against_pool(corpus, "report_id", "text", numbers))


@query("eval_headline_extract", "orders")
def _(m):
    facts = _evidence(m)
    text = report.report_text(report.render(facts))
    numbers = evidence.evidence_numbers(facts)
    return feeds.eval_headline(claims.score_against_pool(text, "report_id", "text", numbers),
                               redteam.red_team_against_pool(text, "report_id", "text", numbers))


# --- data tests --------------------------------------------------------------------------------


def _tests(m: Model, kind: str) -> DataFrame:
    return q.run_tests(pipeline.tested_table(m), [t for t in pipeline.data_tests(schemas.ORDER_STATUSES) if t.kind == kind])


@query("test_unique", "orders", "products")
def _(m):
    return _tests(m, "unique")


@query("test_not_null", "orders", "products")
def _(m):
    return _tests(m, "not_null")


@query("test_relationships", "orders", "marketing_spend")
def _(m):
    return _tests(m, "relationships")


@query("test_accepted_values")
def _(m):
    return _tests(m, "accepted_values")


@query("test_integrity")
def _(m):
    return q.run_tests(pipeline.tested_table(m), pipeline.integrity_tests())


@query("data_test_report", "orders", "products", "marketing_spend")
def _(m):
    return q.run_tests(pipeline.tested_table(m.prepare()), pipeline.data_tests(schemas.ORDER_STATUSES) + pipeline.integrity_tests())


# --- measures ----------------------------------------------------------------------------------


@query("measures_orders")
def _(m):
    return measures.order_measures(m.staged("orders"), ["country_code", "channel"])


@query("revenue_yoy")
def _(m):
    return _rounded(measures.revenue_yoy(m.staged("orders"), ["country_code"]), 6, "revenue_yoy")


@query("revenue_yoy_quarterly")
def _(m):
    return _rounded(measures.revenue_yoy(m.staged("orders"), ["country_code"], "quarter"), 6, "revenue_yoy")


@query("revenue_yoy_yearly")
def _(m):
    return _rounded(measures.revenue_yoy(m.staged("orders"), ["country_code"], "year"), 6, "revenue_yoy")


@query("revenue_mom_calendar")
def _(m):
    return _rounded(measures.revenue_mom_calendar(m.staged("orders"), ["country_code"]), 6, "revenue_mom")


@query("cancel_rate")
def _(m):
    return measures.cancel_rate(m.staged("orders"), ["country_code"])


@query("cancel_rate_filtered")
def _(m):
    """Under a filter on country and status: the one on status is lifted."""
    shown = {"country_code": ["NATION_1", "NATION_2", "NATION_3"], "status": ["cancelled"]}
    return measures.cancel_rate(m.staged("orders"), ["channel"], shown)


@query("measures_customers")
def _(m):
    return measures.customer_measures(m.staged("orders"), m.customer_ltv, ["country_code"])


@query("new_customers")
def _(m):
    return measures.new_customers(m.staged("customers"))


@query("measures_products")
def _(m):
    return measures.product_measures(m.fct_order_items, m.dim_product, ["category"])


@query("measures_returns")
def _(m):
    return measures.return_measures(m.staged("returns"), m.staged("orders"))


@query("measures_marketing")
def _(m):
    return measures.marketing_measures(m.staged("marketing_spend"), m.staged("orders"))


@query("measures_returns_quarterly")
def _(m):
    return measures.return_measures(m.staged("returns"), m.staged("orders"), ["quarter"])


@query("measures_returns_total")
def _(m):
    return measures.return_measures(m.staged("returns"), m.staged("orders"), [])


@query("measures_marketing_yearly")
def _(m):
    return measures.marketing_measures(m.staged("marketing_spend"), m.staged("orders"), ["year"])


@query("anomaly_overlay")
def _(m):
    return measures.anomaly_overlay(m.dim_date, m.revenue_anomalies)
