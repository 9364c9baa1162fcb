"""Time the headline queries: one JSON line, seconds per query and in total."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ordermart.plans.queries import QUERIES  # noqa: E402
from ordermart.session import clear_stage  # noqa: E402

HEADLINE = [
    "merge_wide",
    "clean_wide",
    "clean_median_fill",
    "dim_customers",
    "dim_sellers",
    "dim_products",
    "dim_payment_types",
    "dim_reviews",
    "fact_orders",
    "agg_sales_by_category",
    "agg_sales_by_customer_state",
    "agg_sales_by_seller",
    "agg_monthly_sales_trend",
    "agg_avg_review_score",
    "dm_sales_performance",
    "dm_product_category_analysis",
    "dm_customer_behavior",
    "dm_order_fulfillment",
    "dm_payment_analysis",
    "top10_customers",
    "share_sales_by_seller_state",
    "warehouse_refresh",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ordermart-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the executors and load the classes before the clock runs.
    QUERIES["dm_payment_analysis"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        best = []
        for _ in range(runs):
            start = time.perf_counter()
            # The noop sink takes every row and column, unlike a count.
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best.append(time.perf_counter() - start)
        if os.environ.get("BENCH_VERBOSE"):
            print(name, [round(s, 3) for s in best], file=sys.stderr, flush=True)
        times[name] = round(sorted(best)[len(best) // 2], 3)
    clear_stage(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
