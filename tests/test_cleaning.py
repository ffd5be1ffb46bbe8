from datetime import date
from decimal import Decimal as D

import pytest

from pyspark.sql import functions as F
from tradewind.operators.calendar import fill_days, fill_forward_then_back
from tradewind.operators.dedupe import keep_first
from tradewind.plans import audit, clean
from tradewind.sources.fx_payload import flatten_rates, require_rates


def orders(spark, *rows):
    return spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)],
        "ingest_seq long, order_id string, customer_id string, order_date string, country_code string, "
        "channel string, status string, currency_code string, gross_amount_local decimal(12,2), "
        "discount_amount_eur decimal(12,2), shipping_fee_eur decimal(12,2), net_amount_eur decimal(12,2)")


def order(oid, net="10.00", day="2024-01-01"):
    return (oid, "C1", day, " de ", "web", "completed", "eur", D("12.00"), D("0.00"), D("0.00"),
            D(net) if net else None)


def test_first_row_wins_and_null_keys_are_one_key(spark):
    df = spark.createDataFrame([(1, "a", "x"), (0, "a", "y"), (3, None, "p"), (2, None, "q")], "s int, k string, v string")
    assert sorted(map(tuple, keep_first(df, ["k"], "s").select("k", "v").collect()), key=repr) == [
        ("a", "y"), (None, "q")]


def test_orders_are_repaired_and_flagged(spark):
    raw = orders(spark, order("O1", "-5.00", "05/03/2024"), order("O1", "7.00"), order("O2"), order("O3", None))
    got = {r.order_id: r for r in clean.clean_orders(raw).collect()}
    assert len(got) == 3
    assert got["O1"].net_amount_eur == D("5.00") and got["O1"].data_quality_flag == "corrected_negative_amount"
    assert got["O1"].order_date == date(2024, 3, 5) and got["O1"].country_code == "DE"
    assert got["O1"].currency_code == "EUR" and got["O1"].gross_amount_eur == D("12.00")
    assert got["O2"].data_quality_flag is None and got["O3"].net_amount_eur is None


def test_cleaning_twice_changes_nothing(spark):
    once = clean.clean_orders(orders(spark, order("O1", "-5.00", "05/03/2024"), order("O2")))
    again = clean.clean_orders(once.withColumn("ingest_seq", F.lit(1)).withColumn("order_date", F.col("order_date").cast("string"))
                               .withColumnRenamed("gross_amount_eur", "gross_amount_local"))
    keep = [c for c in once.columns if c != "data_quality_flag"]
    assert sorted(once.select(keep).collect()) == sorted(again.select(keep).collect())


def test_customers(spark):
    raw = spark.createDataFrame(
        [(1, "C1", "  Ann", "Lee\t", None, "F", "1990-02-30", "2024-01-05", "zz", "X", "ads", "False"),
         (2, "C1", "Other", "Lee", "a@b", "F", "1990-01-01", "2024-01-05", "de", "X", "ads", "True"),
         (3, "C2", "Bo", "Xu", "b@c", "M", "1990-01-01", "2024-01-05", " se ", "X", "ads", None)],
        "ingest_seq long, customer_id string, first_name string, last_name string, email string, gender string, "
        "birth_date string, signup_date string, country_code string, city string, acquisition_channel string, "
        "marketing_opt_in string")
    a, b = clean.clean_customers(raw).orderBy("customer_id").collect()
    assert (a.first_name, a.last_name, a.birth_date, a.country_code, a.marketing_opt_in) == (
        "Ann", "Lee", None, "UNK", False)
    assert (b.country_code, b.marketing_opt_in) == ("SE", None)
    rows = {(r.column_name): (r.null_rows, r.null_share) for r in audit.null_audit(raw, ["email"], "customers").collect()}
    assert rows == {"email": (1, 1 / 3)}


def products(spark, *rows):
    return spark.createDataFrame(list(rows), "product_id string, product_name string, category string, brand string, "
                                 "unit_cost_eur decimal(10,2), unit_price_eur decimal(10,2), launch_date string")


def test_missing_costs_use_the_median_ratio_of_the_category(spark):
    raw = products(
        spark,
        ("1", "a", "fashion", "b", D("4.00"), D("10.00"), "2024-01-01"),
        ("2", "a", " FASHION", "b", D("6.00"), D("10.00"), "2024-01-01"),
        ("3", "a", "Fashion ", "b", None, D("20.00"), "2024-01-01"),
        ("4", "a", "grocery", "b", None, D("30.00"), "bad"),
        ("5", "a", "odd", "b", D("9.00"), D("10.00"), None),
        ("6", "a", "odd", "b", D("1.00"), D("0.00"), None))
    got = {r.product_id: r for r in clean.clean_products(raw).collect()}
    assert got["3"].unit_cost_eur == D("10.00")  # 0.5 in the category
    assert got["4"].unit_cost_eur == D("18.00")  # nothing known: 0.6 overall
    assert got["4"].launch_date is None and got["5"].category == "Unknown" and len(got) == 6


def test_returns_spend_and_payments(spark):
    r = spark.createDataFrame([("R1", "O1", "05-03-2024", None, D("1.00"))],
                              "return_id string, order_id string, return_date string, return_reason string, "
                              "refund_amount_eur decimal(12,2)")
    got = clean.clean_returns(r).first()
    assert got.return_reason == "unspecified" and got.return_date == date(2024, 3, 5)
    s = spark.createDataFrame([("2024-01-01", D("-3.00")), ("2024-01-02", None), ("2024-01-03", D("4.00"))],
                              "date string, spend_eur decimal(18,2)")
    assert [x.spend_eur for x in clean.clean_spend(s).orderBy("date").collect()] == [D("0.00"), None, D("4.00")]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast"):
        clean.clean_spend(spark.createDataFrame([("x", D("1.00"))], "date string, spend_eur decimal(18,2)")).collect()
    p = spark.createDataFrame([(2, "O1", "Card"), (1, "O1", " PayPal ")], "ingest_seq long, order_id string, payment_method string")
    assert clean.clean_payments(p.withColumn("payment_status", F.lit("paid"))).first().payment_method == "paypal"


def test_rates(spark):
    raw = spark.createDataFrame([("2024-01-01", "GBP", D("0.8000")), ("2024-01-01", "SEK", D("11.0000"))],
                                "date string, currency_code string, rate_to_eur decimal(10,4)")
    got = sorted(map(tuple, clean.clean_rates(raw).collect()))
    assert got[0] == (date(2024, 1, 1), "EUR", D("1.0000")) and len(got) == 3
    r = spark.createDataFrame([(date(2024, 1, 3), "GBP", 2.0), (date(2024, 1, 5), "GBP", 3.0)],
                              "date date, currency_code string, rate_to_eur double")
    dense = fill_forward_then_back(r, F.lit("2024-01-01").cast("date"), F.lit("2024-01-06").cast("date"))
    assert [x.rate_to_eur for x in dense.orderBy("date").collect()] == [2.0, 2.0, 2.0, 2.0, 3.0, 3.0]


def test_payloads(spark):
    body = '{"rates": {"2024-01-01": {"GBP": 0.8, "JPY": 160.0}, "2024-01-02": {"SEK": 11.2}}}'
    got = flatten_rates(spark.createDataFrame([(body,)], "payload string"), ["GBP", "SEK"])
    assert sorted(map(tuple, got.collect())) == [("2024-01-01", "GBP", 0.8), ("2024-01-02", "SEK", 11.2)]
    assert require_rates(got).count() == 2
    empty = flatten_rates(spark.createDataFrame([('{"rates": {}}',)], "payload string"), ["GBP"])
    with pytest.raises(Exception, match="no rates"):
        require_rates(empty).collect()


def test_silent_days_become_zero(spark):
    d = spark.createDataFrame([(date(2024, 1, 1), 5.0, 1), (date(2024, 1, 4), 7.0, 2)],
                              "date date, net_revenue_eur double, orders_count long")
    got = fill_days(d, ["net_revenue_eur", "orders_count"]).orderBy("date").collect()
    assert [(r.net_revenue_eur, r.orders_count) for r in got] == [(5.0, 1), (0.0, 0), (0.0, 0), (7.0, 2)]
