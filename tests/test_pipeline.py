import os
from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tradewind import sinks
from tradewind.operators import quality as q
from tradewind.plans import evidence, marts, measures, pipeline
from tradewind.plans.model import EXPORTED, Model
from tradewind.registry import model
from tradewind.scale import scratch_dir
from tradewind.sources import adapter
from tradewind.sources.csv import REASONS, count_rejects, read_csv, read_extract, read_or_quarantine, write_csv
from tradewind.sources.schemas import RAW_SCHEMAS

ORDER = "order_id string, customer_id string, order_date date, country_code string, status string, net_amount_eur decimal(12,2)"


def orders(spark, *rows):
    return spark.createDataFrame([(f"O{i}", c, date.fromisoformat(d), k, s, D(n)) for i, (c, d, k, s, n) in enumerate(rows)], ORDER)


def test_growth_uses_the_previous_row_or_the_previous_month(spark):
    o = orders(spark, ("C1", "2024-01-05", "DE", "completed", "100"), ("C1", "2024-03-05", "DE", "completed", "150"),
               ("C2", "2024-03-06", "DE", "cancelled", "50"), ("C3", "2025-03-01", "DE", "completed", "400"))
    rows = {str(r.month): r for r in marts.monthly_revenue_kpis(o).collect()}
    assert rows["2024-03-01"].prev_month_revenue_eur == 100 and rows["2024-03-01"].mom_revenue_growth_pct == 50.0
    months = {str(r.month): r for r in measures.revenue_mom_calendar(o).collect()}
    assert months["2024-03-01"].net_revenue_pm_eur is None and months["2024-03-01"].net_revenue_eur == 200
    years = {str(r.month): r for r in measures.revenue_yoy(o).collect()}
    assert years["2025-03-01"].revenue_yoy == 1.0 and years["2024-03-01"].revenue_yoy is None
    assert measures.cancel_rate(o, ["country_code"]).first().cancelled_order_rate == 0.25


def test_cohorts(spark):
    o = orders(spark, ("C1", "2024-01-31", "DE", "completed", "1"), ("C1", "2024-02-01", "DE", "completed", "1"),
               ("C2", "2024-01-02", "DE", "completed", "1"), ("C3", "2024-02-02", "DE", "cancelled", "1"))
    got = {(str(r.cohort_month), r.months_since_first_order): (r.active_customers, r.cohort_size, r.retention_rate_pct)
           for r in marts.cohort_retention(o).collect()}
    assert got == {("2024-01-01", 0): (2, 2, 100.0), ("2024-01-01", 1): (1, 2, 50.0)}


def test_lifecycle_stages(spark):
    o = orders(spark, ("A", "2024-12-31", "DE", "completed", "5"), ("A", "2024-12-01", "DE", "completed", "6"),
               ("B", "2024-10-02", "DE", "completed", "5"), ("C", "2024-07-04", "DE", "completed", "5"),
               ("D", "2024-07-03", "DE", "completed", "5"), ("E", "2024-12-31", "DE", "cancelled", "5"))
    c = spark.createDataFrame([(x, "DE", "West", "ads", date(2024, 1, 1)) for x in "ABCDEF"],
                              "customer_id string, country_code string, region string, acquisition_channel string, signup_date date")
    got = {r.customer_id: r for r in marts.customer_ltv(c, o).collect()}
    assert {k: r.lifecycle_stage for k, r in got.items()} == {
        "A": "active", "B": "active", "C": "at_risk", "D": "churned", "E": "never_purchased", "F": "never_purchased"}
    assert (got["A"].total_orders, got["A"].avg_order_value_eur, got["A"].customer_lifespan_days) == (2, 5.5, 30)
    m = measures.customer_measures(o, marts.customer_ltv(c, o), ["country_code"]).first()
    assert (m.active_customers, m.purchasers, m.repeat_purchase_rate, m.churn_rate) == (5, 4, 0.25, 0.25)


def test_return_fan_out(spark):
    p = spark.createDataFrame([("P1", "a", "c", "b", D("1.00")), ("P2", "b", "c", "b", D("1.00"))],
                              "product_id string, product_name string, category string, brand string, unit_cost_eur decimal(10,2)")
    i = spark.createDataFrame([("O1", "P1", 2, D("10.00")), ("O1", "P1", 1, D("5.00")), ("O2", "P1", 1, D("4.00"))],
                              "order_id string, product_id string, quantity int, line_total_eur decimal(12,2)")
    r = spark.createDataFrame([("R1", "O1"), ("R2", "O1")], "return_id string, order_id string")
    wide, none = marts.product_performance(p, i, r).orderBy("product_id").collect()
    assert (wide.orders_count, wide.units_sold, wide.gross_revenue_eur, wide.gross_margin_eur) == (2, 7, 34.0, 27.0)
    assert (wide.returns_count, wide.return_rate_pct) == (2, 100.0)
    assert (none.orders_count, none.units_sold, none.margin_pct, none.return_rate_pct) == (0, None, None, None)
    flat = marts.product_performance(p, i, r, fan_out=False).orderBy("product_id").first()
    assert (flat.units_sold, flat.gross_revenue_eur, flat.returns_count) == (4, 19.0, 2)


def test_product_amounts_are_summed_as_cents(spark):
    p = spark.createDataFrame([("P1", "a", "c", "b", D("0.01")), ("P2", "a", "c", "b", None)],
                              "product_id string, product_name string, category string, brand string, unit_cost_eur decimal(10,2)")
    i = spark.createDataFrame([("O1", "P1", 1, D("9999999999.99")), ("O2", "P1", 1, D("-0.02")), (None, "P1", None, None), ("O1", "P2", 3, None)],
                              "order_id string, product_id string, quantity int, line_total_eur decimal(12,2)")
    r = spark.createDataFrame([("R1", "O1"), ("R2", "O1"), ("R3", None)], "return_id string, order_id string")
    got = marts.product_performance(p, i, r)
    assert "sum(line_total_eur" not in got._jdf.queryExecution().executedPlan().toString()
    one, two = got.orderBy("product_id").collect()
    assert (one.orders_count, one.units_sold, one.gross_revenue_eur, one.gross_margin_eur) == (2, 3, 19999999999.96, 19999999999.93)
    assert (two.orders_count, two.units_sold, two.gross_revenue_eur, two.gross_margin_eur) == (1, 6, None, None)
    wide = i.withColumn("line_total_eur", F.col("line_total_eur").cast("decimal(30,4)"))
    assert marts.product_performance(p, wide, r).orderBy("product_id").first().gross_revenue_eur == 19999999999.96


def test_data_tests(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "z"), (None, None), ("b", "x")], "k string, v string")
    parent = spark.createDataFrame([("a",)], "k string")
    got = [r.failures for r in q.report([
        q.unique(df, "t", "k"), q.not_null(df, "t", "k"), q.accepted_values(df, "t", "v", ["x", "y"]),
        q.relationship(df, "t", "k", parent, "k"), q.duplicates(df, "t", "k"), q.orphans(df, "t", "k", parent, "k")]).collect()]
    assert got == [1, 2, 1, 1, 3, 3]
    empty = df.where("false")
    assert [r.failures for r in q.report([q.unique(empty, "t", "k"), q.orphans(empty, "t", "k", parent, "k")]).collect()] == [0, 0]


def test_csv_keeps_quotes_blanks_and_record_order(spark, tmp_path):
    rows = [(f"C{i}", ' a "b", c ', "NA" if i else "x") for i in range(3)]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    write_csv(df.coalesce(1), f"{tmp_path}/t")
    back = read_csv(spark, f"{tmp_path}/t", "a string, b string, c string", with_order=True).orderBy("ingest_seq")
    assert [(r.a, r.b, r.c) for r in back.collect()] == [(a, b, None if c == "NA" else c) for a, b, c in rows]
    (tmp_path / "orders_raw.csv").write_text(
        "order_id,customer_id,order_date,country_code,channel,status,currency_code,gross_amount_local,"
        "discount_amount_eur,shipping_fee_eur,net_amount_eur\nO1,C1,05/03/2024, de,web,completed,eur,10.5,0,,-9.25\n"
        "O1,C2,2024-03-05,fr,web,completed,eur,1,0,0,1\n")
    from tradewind.plans.clean import clean_orders
    row, = clean_orders(read_extract(spark, str(tmp_path / "orders_raw.csv"), "orders")).collect()
    assert (row.customer_id, row.net_amount_eur, row.shipping_fee_eur) == ("C1", D("9.25"), None)


ORDER_HEADER = ("order_id,customer_id,order_date,country_code,channel,status,currency_code,gross_amount_local,"
                "discount_amount_eur,shipping_fee_eur,net_amount_eur")


def test_cells_follow_the_header_and_none_is_lost(spark, tmp_path):
    columns = ORDER_HEADER.split(",")
    cells = dict(zip(columns, "O1,C1,2024-03-05,DE,web,completed,EUR,10.50,0,1.25,12.30".split(","), strict=True))
    turned = columns[::-1] + ["remark"]
    (tmp_path / "turned.csv").write_text(",".join(turned) + "\n" + ",".join({**cells, "remark": "x"}[c] for c in turned) + "\n")
    row, = read_extract(spark, str(tmp_path / "turned.csv"), "orders").collect()
    assert (row.order_id, row.net_amount_eur, row.shipping_fee_eur) == ("O1", D("12.30"), D("1.25"))
    wide = {**cells, "net_amount_eur": "12345678901.00", "gross_amount_local": "ten", "shipping_fee_eur": "NA"}
    (tmp_path / "wide.csv").write_text(ORDER_HEADER + "\n" + ",".join(wide.values()) + "\n")
    path = str(tmp_path / "wide.csv")
    with pytest.raises(Exception, match="takes decimal"):
        read_extract(spark, path, "orders").collect()
    row, = read_extract(spark, path, "orders", strict=False).collect()
    assert row.net_amount_eur is None and row.shipping_fee_eur is None
    rejects = {r.column_name: r.rejected for r in count_rejects(spark, path, RAW_SCHEMAS["orders"], "orders").collect()}
    assert rejects == {"gross_amount_local": 1, "discount_amount_eur": 0, "shipping_fee_eur": 0, "net_amount_eur": 1}
    (tmp_path / "lacking.csv").write_text("order_id,customer_id\nO1,C1\n")
    with pytest.raises(ValueError, match="no column"):
        read_extract(spark, str(tmp_path / "lacking.csv"), "orders")


def test_days_without_a_fixing_take_the_last_one(spark, sf_dir):
    m = model(spark, sf_dir)
    orders = m.fct_orders.where("currency_code in ('USD', 'GBP', 'SEK')")
    assert orders.where("fx_rate_to_eur = 1").count() == 0  # none of these was ever quoted at 1
    one = m.staged("exchange_rates").where("currency_code = 'SEK' and date in ('1996-03-06', '1996-03-07')").collect()
    assert len(one) == 2 and len({r.rate_to_eur for r in one}) == 1  # the seventh has no fixing of its own


def test_a_status_filter_does_not_change_the_cancel_rate(spark):
    orders = spark.createDataFrame([(1, "DE", "cancelled"), (2, "DE", "completed"), (3, "DE", "completed"), (4, "FR", "cancelled")],
                                   "order_id long, country_code string, status string")
    row, = measures.cancel_rate(orders, [], {"status": ["cancelled"], "country_code": ["DE"]}).collect()
    assert (row.cancelled_orders, row.orders) == (1, 3)


def test_a_broken_fact_fails_its_own_tests(spark, sf_dir):
    m = model(spark, sf_dir)
    good = m.fct_orders
    broken = good.limit(3).withColumn("customer_id", F.lit("nobody")).withColumn("status", F.lit("lost"))
    m.__dict__["fct_orders"] = good.unionByName(broken)
    tests = pipeline.data_tests() + pipeline.integrity_tests()
    rows = q.run_tests(pipeline.tested_table(m), tests).where("table_name = 'fct_orders'").collect()
    failed = {(r.test_name, r.column_name): r.failures for r in rows if r.failures}
    assert failed == {("unique", "order_id"): 3, ("relationships", "customer_id"): 3, ("accepted_values", "status"): 3,
                      ("no_duplicates", "order_id"): 3, ("no_orphans", "customer_id"): 3}


def folded(spark):
    """Tables with nulls, hot keys, duplicates, orphans and values out of range."""
    orders = spark.createDataFrame([(k % 40 if k % 11 else None, f"c{k % 7}" if k % 5 else None, "xyz"[k % 3], k - 3) for k in range(200)],
                                   "id long, customer string, status string, amount long")
    customers = spark.createDataFrame([("c1",), ("c2",), ("c2",), (None,), ("c9",)], "customer string")
    days = spark.sql("select explode(sequence(date'2024-01-01', date'2024-01-05')) as day")
    return {"orders": orders, "customers": customers, "days": days, "none": customers.limit(0)}


def test_folded_tests_equal_single_ones(spark):
    tables = folded(spark)
    orders, customers = tables["orders"], tables["customers"]
    tests = [q.Test("unique", "orders", "id"), q.Test("not_null", "orders", "id"), q.Test("no_duplicates", "orders", "id"),
             q.Test("unique", "customers", "customer"), q.Test("not_null", "customers", "customer"),
             q.Test("relationships", "orders", "customer", ("customers", "customer")),
             q.Test("no_orphans", "orders", "customer", ("customers", "customer")),
             q.Test("accepted_values", "orders", "status", values=("x", "y")), q.Test("not_negative", "orders", "amount"),
             q.Test("unique", "days", "day"), q.Test("unique", "none", "customer"), q.Test("not_null", "none", "customer")]
    single = q.report([
        q.unique(orders, "orders", "id"), q.not_null(orders, "orders", "id"), q.duplicates(orders, "orders", "id"),
        q.unique(customers, "customers", "customer"), q.not_null(customers, "customers", "customer"),
        q.relationship(orders, "orders", "customer", customers, "customer"), q.orphans(orders, "orders", "customer", customers, "customer"),
        q.accepted_values(orders, "orders", "status", ["x", "y"]), q.negative(orders, "orders", "amount"),
        q.unique(tables["days"], "days", "day"), q.unique(tables["none"], "none", "customer"),
        q.not_null(tables["none"], "none", "customer")]).collect()
    got = q.run_tests(tables.__getitem__, tests)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, single))
    assert sum(r.failures > 0 for r in single) > 6


def test_folded_tests_read_each_table_once_and_group_once(spark, tmp_path):
    stored = {}
    for name, df in folded(spark).items():
        df.write.parquet(f"{tmp_path}/{name}")
        stored[name] = spark.read.parquet(f"{tmp_path}/{name}")
    tests = [q.Test("unique", "orders", "id"), q.Test("not_null", "orders", "customer"), q.Test("unique", "customers", "customer"),
             q.Test("relationships", "orders", "customer", ("customers", "customer")),
             q.Test("accepted_values", "orders", "status", values=("x",)), q.Test("unique", "days", "day")]
    text = q.run_tests(stored.__getitem__, tests)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Scan parquet") == 3 and "Join" not in text
    assert text.count("Exchange hashpartitioning") == 1 and text.count("partial_count_if") + text.count("partial_count(") > 0


def test_a_value_is_held_with_as_many_counts_as_its_domain_has_columns(spark):
    tests = [q.Test("unique", "orders", "id"), q.Test("unique", "orders", "amount"), q.Test("unique", "days", "day"),
             q.Test("relationships", "orders", "customer", ("customers", "customer"))]
    text = q.run_tests(folded(spark).__getitem__, tests)._jdf.queryExecution().optimizedPlan().toString()
    grouped = next(line for line in text.splitlines() if "Aggregate [domain" in line)
    assert [f" AS r{k}#" in grouped for k in range(3)] == [True, True, False]


def test_held_tables_and_the_calendar_are_written_once(spark):
    raw = {
        "orders": spark.createDataFrame([("2024-01-05",), ("07/02/2024",), (None,)], "order_date string"),
        "returns": spark.createDataFrame([("R1", "O1", "2024-03-01", None, D("1.00")), ("R2", "O2", "bad", "x", D("2.00"))],
                                         "return_id string, order_id string, return_date string, return_reason string, "
                                         "refund_amount_eur decimal(12,2)"),
        "marketing_spend": spark.createDataFrame([("2023-12-31", "DE", "tv", D("-3.00"), 1, 2, 3), (None, "FR", "tv", D("4.00"), 1, 2, 3)],
                                                 "date string, country_code string, channel string, spend_eur decimal(18,2), "
                                                 "impressions long, clicks long, conversions long")}
    direct = Model.over(raw)
    m = Model.over(raw, hold=("returns", "marketing_spend")).prepare()
    for name in ("returns", "marketing_spend"):
        assert all(scratch_dir(spark).removeprefix("file:") in f for f in m.staged(name).inputFiles()) and m.staged(name).inputFiles()
        assert sorted(map(str, m.staged(name).collect())) == sorted(map(str, direct.staged(name).collect()))
        assert m.staged(name).schema.simpleString() == direct.staged(name).schema.simpleString()
    assert tuple(m.calendar.first()) == tuple(direct.calendar.first()) == (date(2023, 12, 31), date(2024, 3, 1))
    assert m.calendar.inputFiles()  # a stored row, so that later readers don't read orders, returns and spend again


def test_scratch_folder_comes_from_the_session(spark):
    assert scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_a_set_is_published_whole_or_not_at_all(spark, tmp_path):
    folder = str(tmp_path / "set")
    assert sinks.published(spark, folder) == {}
    good = {"a": spark.range(5), "b": spark.range(7).withColumn("v", F.lit("x, \"y\"")), "none": spark.range(0)}
    assert sinks.export_csv(good, folder, {"a": ("id",)}) == {"a": 5, "b": 7, "none": 0}
    first = sinks.published(spark, folder)
    assert set(first) == set(good) and spark.read.csv(first["b"], header=True, escape='"').where("v = 'x, \"y\"'").count() == 7
    broken = {**good, "a": spark.range(9), "bad": spark.range(3).select(F.raise_error(F.lit("stop")).cast("string").alias("x"))}
    with pytest.raises(Exception, match="stop"):
        sinks.export_csv(broken, folder)
    assert sinks.published(spark, folder) == first
    sinks.export_csv({"a": spark.range(9)}, folder)
    again = sinks.published(spark, folder)
    assert set(again) == {"a"} and spark.read.csv(again["a"], header=True).count() == 9
    manifest = spark.read.schema(sinks.MANIFEST).json(f"{folder}/manifest").where("table_name = 'b'").first()
    assert manifest.rows == 7 and manifest.table_schema == "struct<id:bigint,v:string>" and manifest.files


def test_records_are_kept_or_quarantined(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    lines = ["note,amount,id", "fine,1.50,1", "NA,,2", "wide,98765432109876.54,3", "two faults,x,y", '"broken "quote,2.00,4', "short,5",
             'said ""hi"",3.00,6', '"a, b",4.00,7', "long,1.00,8,9", "last,-2.25,10"]
    (folder / "part.csv").write_text("\n".join(lines) + "\n")
    (folder / "other.csv").write_text("note,amount,id\nmore,7.00,11\nbad,seven,12\n")
    kept, lost = read_or_quarantine(spark, str(folder), "id int, amount decimal(12,2), note string")
    good = {r.id: (r.amount, r.note) for r in kept.collect()}
    assert kept.columns == ["id", "amount", "note"]
    assert {1, 2, 7, 10, 11} <= set(good) and good[2] == (None, None) and good[7] == (D("4.00"), "a, b") and not {3, 8, 12} & set(good)
    faults = lost.collect()
    places = {(r.file, r.block, r.row) for r in faults}
    assert len(good) + len(places) == 12  # every record once
    told = {(r.column_name, r.cell, r.reason) for r in faults}
    assert {("amount", "98765432109876.54", REASONS[0]), ("amount", "x", REASONS[0]), ("id", "y", REASONS[0]), ("amount", "seven", REASONS[0]),
            ("", "short,5", REASONS[1]), ("", "long,1.00,8,9", REASONS[1])} <= told
    assert sum(r.cell in ("x", "y") for r in faults) == 2 and len({(r.file, r.row) for r in faults if r.cell in ("x", "y")}) == 1


def test_evidence_document_holds_the_evidence(spark, tmp_path):
    rows = [("headline", 1, "all", "total", 12.5, None), ("headline", 1, "all", "month", None, "2024-05-01"),
            ("top", 1, 'é "x"', "n", 3.0, None), ("top", 2, "b", "n", 1e15, None)]
    facts = spark.createDataFrame(rows, "section string, rank long, entity string, metric string, value_num double, value_str string")
    sinks.write_document(evidence.evidence_json(facts), f"{tmp_path}/doc")
    read = sinks.read_document(spark, f"{tmp_path}/doc")
    back = [(s, e["rank"], e["entity"], f["metric"], f.get("value_num"), f.get("value_str"))
            for s, held in read.items() for e in held for f in e["facts"]]
    assert sorted(back, key=str) == sorted(rows, key=str)


def test_whole_run(spark, sf_dir, tmp_path):
    read = adapter.extract_reader(spark, sf_dir)
    counts = pipeline.run(spark, read, str(tmp_path), adapter.INCIDENTS, adapter.VALID_CODES, adapter.CATEGORY_NAMES, buckets=4)
    assert set(EXPORTED) <= set(counts) and counts["fct_orders"] == 1500
    m = model(spark, sf_dir)
    assert counts["fct_order_items"] == m.fct_order_items.count()
    for name in ("data_tests", "evidence", "report", "groundedness", "anomaly_eval", "data_quality_report"):
        assert os.path.exists(f"{tmp_path}/{name}/_SUCCESS"), name
    exports, analysis, shown = (sinks.published(spark, f"{tmp_path}/{s}") for s in ("exports", "analysis", "feeds"))
    assert set(exports) == set(EXPORTED) and "revenue_anomalies" in analysis and {"anomaly_feed", "headline_kpis"} <= set(shown)
    text = spark.read.text(f"{tmp_path}/report")
    assert text.where(F.col("value").startswith("# ")).count() == 8
    months = [(r.country_code, r.month) for r in spark.read.csv(exports["monthly_revenue_kpis"], header=True).collect()]
    assert months == sorted(months)
    flags = spark.read.csv(analysis["daily_revenue_with_flags"], header=True)
    assert {"zscore_anomaly", "poisson_z"} <= set(flags.columns)
    assert "first_order_date" in spark.read.csv(analysis["customer_rfm_segments"], header=True).columns
    assert counts["anomaly_feed"] == flags.where("stl_poisson_anomaly = 'true'").count()
    failures = spark.read.csv(f"{tmp_path}/data_tests", header=True).where("failures <> '0'").collect()
    # the planted unknown country fails its relationship test, and nothing else does
    assert {(r.test_name, r.column_name) for r in failures} == {("relationships", "country_code")}
