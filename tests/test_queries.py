"""Every registered query with an oracle against DuckDB on the smallest tables, and the shape of hot plans."""

import math
import re

import pytest

import __spark_entry__ as entry_point
from oracle.queries import ORACLE
from tradewind.registry import QUERIES, model

duckdb = pytest.importorskip("duckdb")
TABLES = "region nation customer supplier part orders lineitem documents".split()
ROWS_ONLY = {"evidence_json", "stl_poisson", "stl_anomaly_feed", "detector_scores_stl", "threshold_sweep_stl",
             "anomaly_eval_lines"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    yield con
    con.close()


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)

    def value(v):
        return None if isinstance(v, float) and math.isnan(v) else v

    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_is_checked_or_listed_as_rows_only():
    assert set(QUERIES) - set(ORACLE) <= ROWS_ONLY
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(name, spark, sf_dir, duck):
    df = QUERIES[name](spark, sf_dir)
    done = duck.execute(ORACLE[name])
    columns = [c[0] for c in done.description]
    assert sorted(columns) == sorted(df.columns)
    assert comparable(df.columns, [tuple(r) for r in df.collect()]) == comparable(columns, done.fetchall())


@pytest.mark.parametrize("name", ["stl_poisson", "anomaly_eval_lines"])
def test_rows_only_queries_give_rows(name, spark, sf_dir):
    assert QUERIES[name](spark, sf_dir).count() > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_duplicates_are_limited_before_the_exchange(spark, sf_dir):
    text = plan(QUERIES["clean_orders"](spark, sf_dir))
    before = text[text.index("Exchange hashpartitioning(order_id"):]
    assert re.search(r"WindowGroupLimit .*Partial", before)


@pytest.mark.parametrize("name", ["monthly_revenue_kpis", "cohort_retention", "product_performance", "fct_orders",
                                  "customer_ltv", "marketing_roi", "clean_items", "groundedness_score"])
def test_no_cross_join_python_or_single_partition_in_hot_plans(name, spark, sf_dir):
    text = plan(QUERIES[name](spark, sf_dir))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition", "ArrowEvalPython", "BatchEvalPython"):
        assert word not in text.split("Subquery")[0], word


def test_monthly_mart_reads_only_its_columns_once(spark, sf_dir):
    text = plan(QUERIES["monthly_revenue_kpis"](spark, sf_dir))
    assert "o_orderpriority" not in text and text.count("Join") == 0


def test_status_filter_reaches_stored_tables(spark, sf_dir):
    from tradewind.plans.marts import monthly_revenue_kpis
    stored = model(spark, sf_dir, ("orders",)).staged("orders")
    assert "EqualTo(status,completed)" in plan(monthly_revenue_kpis(stored))


def test_entry_has_rows(spark, sf_dir):
    assert entry_point.entry(spark).limit(1).count() == 1
