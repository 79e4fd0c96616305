"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is timed from its description to the last row written to a no-op sink. One small query warms the session up;
every headline query then runs twice and the faster run counts.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

HEADLINE = [
    "silver_daily_sales",
    "gold_fact_purchase_orders",
    "supplier_scorecard",
    "inventory_health",
    "weekly_demand_panel",
    "moving_average_accuracy",
    "smoothing_accuracy",
    "reconcile_top_down",
    "boosted_tree_forecast",
    "reorder_recommendations",
    "scenario_summary",
    "promotion_uplift_summary",
    "anomalies_by_step",
    "isolation_forest_anomalies",
    "delivery_risk_metrics",
    "quality_rules",
    "demand_drift",
    "business_kpis",
    "turnover_measures",
    "units_sold_month_over_month",
]


def timed(spark: SparkSession, run, folder: str) -> float:
    begin = time.perf_counter()
    run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    from checks.queries import QUERIES

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    timed(spark, QUERIES["silver_products"], folder)
    seconds = {n: round(min(timed(spark, QUERIES[n], folder) for _ in range(2)), 3) for n in HEADLINE}
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": sf}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
