"""Marts on facts where one order, product, customer and country each hold a third of the rows, against literal SQL."""

import pytest
from pyspark.sql import functions as F

from tradewind.operators.dedupe import distinct_rows, keep_first
from tradewind.plans import marts
from tradewind.session import apply_conf

N = 30000


def hot(expr, value):
    """A third of the rows take ``value``."""
    return F.when(F.col("id") % 3 == 0, F.lit(value)).otherwise(expr)


@pytest.fixture(scope="module")
def facts(spark):
    rows = spark.range(N)
    money = (F.col("id") % 977 / 4 + 1).cast("decimal(12,2)")
    orders = rows.select(
        F.concat(F.lit("O"), "id").alias("order_id"),
        hot(F.concat(F.lit("C"), F.col("id") % 4001), "C0").alias("customer_id"),
        F.date_add(F.lit("2023-01-01").cast("date"), (F.col("id") * 7 % 900).cast("int")).alias("order_date"),
        hot(F.concat(F.lit("K"), F.col("id") % 7), "K0").alias("country_code"),
        F.when(F.col("id") % 5 == 0, "cancelled").otherwise("completed").alias("status"), money.alias("net_amount_eur"))
    items = rows.select(
        hot(F.concat(F.lit("O"), F.col("id") % 9000), "O1").alias("order_id"),
        F.when(F.col("id") % 3 == 1, "P0").otherwise(F.concat(F.lit("P"), F.col("id") % 500)).alias("product_id"),
        (F.col("id") % 9 + 1).cast("int").alias("quantity"), money.alias("line_total_eur"))
    returns = spark.range(4000).select(F.concat(F.lit("R"), "id").alias("return_id"),
                                       F.when(F.col("id") % 1000 < 3, "O1").otherwise(F.concat(F.lit("O"), F.col("id") % 3500)).alias("order_id"))
    products = spark.range(520).select(
        F.concat(F.lit("P"), "id").alias("product_id"), F.lit("n").alias("product_name"), F.lit("c").alias("category"),
        F.lit("b").alias("brand"), F.when(F.col("id") % 50 != 9, (F.col("id") / 8).cast("decimal(10,2)")).alias("unit_cost_eur"))
    tables = {"orders": orders, "items": items, "returns": returns, "products": products}
    for name, df in tables.items():
        df.createOrReplaceTempView(f"skew_{name}")
    return tables


def same(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    assert sorted(left.select(columns).collect(), key=str) == sorted(right.select(columns).collect(), key=str)


def test_product_performance(spark, facts):
    got = marts.product_performance(facts["products"], facts["items"], facts["returns"])
    same(got.select("product_id", "orders_count", "units_sold", "gross_revenue_eur", "gross_margin_eur", "returns_count"), spark.sql("""
        select p.product_id, count(distinct i.order_id) orders_count, sum(i.quantity) units_sold,
               cast(sum(i.line_total_eur) as double) gross_revenue_eur,
               cast(sum(i.line_total_eur - i.quantity * p.unit_cost_eur) as double) gross_margin_eur,
               count(distinct r.return_id) returns_count
        from skew_products p left join skew_items i on p.product_id = i.product_id
        left join skew_returns r on i.order_id = r.order_id group by p.product_id"""))


def test_monthly_and_cohorts(spark, facts):
    got = marts.monthly_revenue_kpis(facts["orders"])
    same(got.select("month", "country_code", "orders_count", "active_customers", "net_revenue_eur"), spark.sql("""
        select trunc(order_date, 'MM') month, country_code, count(distinct order_id) orders_count,
               count(distinct customer_id) active_customers, cast(sum(net_amount_eur) as double) net_revenue_eur
        from skew_orders where status = 'completed' group by 1, 2"""))
    cohorts = marts.cohort_retention(facts["orders"])
    same(cohorts.select("cohort_month", "order_month", "active_customers"), spark.sql("""
        with done as (select * from skew_orders where status = 'completed'),
             first as (select customer_id, trunc(min(order_date), 'MM') m from done group by 1)
        select f.m cohort_month, trunc(o.order_date, 'MM') order_month, count(distinct o.customer_id) active_customers
        from done o join first f on o.customer_id = f.customer_id group by 1, 2"""))
    assert cohorts.where("months_since_first_order = 0 and retention_rate_pct <> 100").count() == 0


def test_copies_of_one_row(spark):
    rows = spark.range(N).select(hot(F.col("id").cast("string"), "copy").alias("k"), F.lit(1).alias("v"), F.col("id").alias("s"))
    assert distinct_rows(rows.drop("s")).count() == N - N // 3 + 1
    first = keep_first(rows, ["k"], F.col("s").desc())
    assert first.count() == N - N // 3 + 1
    assert first.where("k = 'copy'").first().s == N - 3


def test_a_task_gets_a_bounded_share_of_scans_and_exchanges(spark, tmp_path):
    try:
        # splits as where tables are large for the cores
        apply_conf(spark).conf.set("spark.sql.files.minPartitionNum", "1")
        spark.range(0, 2_000_000, 1, 1).selectExpr("uuid() as k").write.option("parquet.block.size", 4 << 20).parquet(f"{tmp_path}/t")
        size = sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
        assert spark.read.parquet(f"{tmp_path}/t").rdd.getNumPartitions() > size >> 25 > 0
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")


def test_a_join_with_a_small_side_sorts_neither(spark, facts):
    apply_conf(spark)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = marts.product_performance(facts["products"], facts["items"], facts["returns"], fan_out=False)
        assert got.count() == len(got.collect()) == 520
        final = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert "ShuffledHashJoin" in final and "SortMergeJoin" not in final
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
