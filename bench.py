"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (input tables), BENCH_CPUS (local cores),
BENCH_QUERIES (comma-separated subset), BENCH_RUNS (timed runs after one warm-up), BENCH_LIMIT (seconds for the whole
run, 1500 unless given). Each figure goes to standard error as it is taken. Once the limit is near, remaining queries are left out
and named in the result, so that a slow query cannot cost the figures of the others.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tradewind.registry import QUERIES  # noqa: E402
from tradewind.session import build_session  # noqa: E402

HEADLINE = (
    "clean_customers", "clean_orders", "clean_items", "clean_products", "fx_fill_calendar",
    "fct_orders", "fct_order_items", "fct_returns", "monthly_revenue_kpis", "customer_ltv", "cohort_retention",
    "product_performance", "marketing_roi", "returns_analysis", "weekday_anomalies", "stl_poisson", "rfm_summary",
    "detector_scores", "extract_claims", "grounded_claims_large_pool", "evidence", "measures_customers",
    "revenue_yoy", "daily_revenue", "low_roas_scan", "groundedness_score", "measures_marketing", "test_relationships",
    "red_team_rate", "export_counts", "data_test_report", "impute_cost",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)
    spark = build_session("tradewind-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.log.level": "ERROR",
        "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tradewind-bench-")})

    def once(name: str) -> float:
        begin = time.perf_counter()
        # the noop sink runs the whole plan without collecting rows on the driver
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    limit, start = float(os.environ.get("BENCH_LIMIT", "1500")), time.perf_counter()
    seconds, cold, left_out = {}, {}, []
    for name in names:
        if time.perf_counter() - start > limit:
            left_out.append(name)
            continue
        cold[name] = round(once(name), 3)
        # a query too slow to run again within the limit is given by its first run
        again = time.perf_counter() - start + runs * cold[name] <= limit
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3) if again else cold[name]
        print(f"{name} {seconds[name]} (first run {cold[name]})", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({"metric": "headline queries, warm, total", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "first_runs": cold, "left_out": left_out,
                      "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()
