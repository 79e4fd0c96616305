import math

import pytest
from pyspark.sql import functions as F

from helpers import day, one, rows
from stockloom.operators import inventory
from stockloom.sources.schemas import RAW_SCHEMAS

# Published recommendations: mean, deviation, lead time, its deviation, safety stock, reorder point. Fixed values.
PUBLISHED = [
    (8.11, 2.58, 9.0, 1.58, 24.7, 97.7),
    (22.71, 5.43, 9.7, 1.44, 60.8, 281.1),
    (12.5, 4.07, 4.0, 0.73, 20.2, 70.2),
    (13.82, 3.73, 18.8, 2.12, 55.2, 315.1),
    (16.93, 4.46, 9.1, 1.59, 49.7, 203.7),
]


def published(spark):
    columns = "demand_mean_daily double, demand_std_daily double, lead_time_days double, lead_time_std_days double, "
    columns += "safety_stock_units double, reorder_point_units double"
    return spark.createDataFrame(PUBLISHED, columns)


def test_formulas_reproduce_published_rows(spark):
    """Inputs are published on two decimals, so the second result may be a rounding step away."""
    again = rows(inventory.apply_scenario(published(spark)), "demand_mean_daily")
    for row, known in zip(again, sorted(PUBLISHED)):
        assert row["safety_stock_units"] == pytest.approx(known[4], abs=0.11)
        assert row["reorder_point_units"] == pytest.approx(known[5], abs=0.6)


def test_scenarios(spark):
    got = {r["scenario"]: r for r in rows(inventory.run_scenarios(published(spark)))}
    assert [r["scenario"] for r in rows(inventory.run_scenarios(published(spark)))] == [n for n, _, _ in inventory.SCENARIOS]
    base = got["Baseline"]["avg_safety_stock_units"]
    assert got["Supplier disruption (+50% lead time)"]["avg_safety_stock_units"] > base
    assert got["Demand slowdown (-20%)"]["avg_safety_stock_units"] < base
    one_row = inventory.run_scenarios(published(spark).limit(1), [("up", 0.35, 0.0), ("down", -0.2, 0.5)])
    m, s, t, u = PUBLISHED[0][:4]

    def stock(m, s, t, u):
        return round(1.65 * math.sqrt(t * s * s + m * m * u * u), 1)

    ss = {r["scenario"]: r["avg_safety_stock_units"] for r in rows(one_row)}
    assert ss["up"] == stock(m * 1.35, s * 1.21, t, u)
    assert ss["down"] == stock(m * 0.8, s * 1.06, t * 1.5, u * 1.4)


def test_demand_statistics_window_and_lone_rows(spark):
    sales = spark.createDataFrame(
        [(day("2026-03-31"), "S", "A", 10), (day("2026-02-04"), "S", "A", 20), (day("2026-02-03"), "S", "A", 999), (day("2026-03-31"), "S", "B", 10)],
        "date date, store_id string, sku_id string, units_sold bigint",
    )
    got = {r["sku_id"]: r for r in rows(inventory.demand_statistics(sales))}
    assert got["A"]["demand_mean"] == 15 and got["A"]["demand_std"] == pytest.approx(math.sqrt(50))
    assert got["B"]["demand_std"] == 3.0


def stats_and_lead(spark):
    stats = spark.createDataFrame(
        [("S1", "A", 10.0, 2.0), ("S2", "A", 20.0, 4.0), ("S1", "B", 5.0, 1.0), ("S1", "C", 5.0, 1.0)],
        "store_id string, sku_id string, demand_mean double, demand_std double",
    )
    lead = spark.createDataFrame(
        [("V1", "A", 4.0, 1.0, 0.9), ("V2", "A", 6.0, 2.0, 0.8), ("V1", "B", 9.0, None, 0.7)],
        "supplier_id string, sku_id string, observed_avg_lead_time_days double, observed_std_lead_time_days double, on_time_rate double",
    )
    skus = spark.createDataFrame([("A", "X", 3.0), ("B", "X", 2.0), ("C", "Y", 1.0)], "sku_id string, category string, unit_cost double")
    return stats, lead, skus


def test_recommendations_per_supplier_with_fallbacks(spark):
    got = rows(inventory.reorder_recommendations(*stats_and_lead(spark)), "store_id", "sku_id", "lead_time_days")
    assert len(got) == 6  # two suppliers of A for two stores, B and C once
    by = {(r["store_id"], r["sku_id"], r["lead_time_days"]): r for r in got}
    assert by["S1", "B", 9.0]["lead_time_std_days"] == 1.5
    # C has no supplier: median over the joined rows 4, 6, 4, 6, 9
    assert ("S1", "C", 6.0) in by and by["S1", "C", 6.0]["supplier_on_time_rate"] is None
    assert {r["economic_order_qty_units"] for r in got} == {386.0}
    assert all(r["reorder_point_units"] >= r["safety_stock_units"] for r in got)


def test_recommendations_by_unit_cost_and_category(spark):
    z = spark.createDataFrame([("X", 1.28)], "category string, z double")
    got = inventory.reorder_recommendations(*stats_and_lead(spark), holding_base="unit_cost", category_z=z)
    by = {(r["store_id"], r["sku_id"]): r for r in rows(got)}
    assert by["S1", "B"]["service_level_z"] == 1.28 and by["S1", "C"]["service_level_z"] == 1.65
    assert by["S1", "B"]["economic_order_qty_units"] == round(math.sqrt(2 * 5 * 365 * 45 / (2 * 0.22)))


def test_lead_times_ignore_unknown_skus(spark):
    orders = spark.createDataFrame(
        [("V", "A", day("2026-01-01"), day("2026-01-05"), day("2026-01-05")), ("V", "A", day("2026-01-01"), day("2026-01-05"), day("2026-01-07")),
         ("V", "GONE", day("2026-01-01"), day("2026-01-05"), day("2026-01-09"))],
        "supplier_id string, sku_id string, order_date date, expected_delivery_date date, actual_delivery_date date",
    )
    skus = spark.createDataFrame([("A",)], "sku_id string")
    assert one(inventory.lead_time_statistics(orders, skus)) == {
        "supplier_id": "V", "sku_id": "A", "quoted_lead_time_days": 4.0, "observed_avg_lead_time_days": 5.0,
        "observed_std_lead_time_days": 1.0, "on_time_rate": 0.5, "sample_size": 2,
    }


def snapshots(spark, values):
    return spark.createDataFrame(values, RAW_SCHEMAS["inventory_snapshots"])


def test_requests_and_allocation(spark):
    stock = snapshots(
        spark,
        [
            (day("2026-01-01"), "Store", "S1", "A", 500.0, 0.0, 0.0, 9.0),
            (day("2026-01-02"), "Store", "S1", "A", 20.0, 10.0, 0.0, 2.0),
            (day("2026-01-02"), "Store", "S2", "A", 10.0, 0.0, 0.0, 1.0),
            (day("2026-01-02"), "Store", "S3", "A", 100.0, 0.0, 0.0, 9.0),
        ],
    )
    recs = spark.createDataFrame(
        [("S1", "A", 50.0), ("S1", "A", 100.0), ("S2", "A", 100.0), ("S3", "A", 100.0)],
        "store_id string, sku_id string, reorder_point_units double",
    )
    wanted = {r["store_id"]: r["request_qty"] for r in rows(inventory.replenishment_requests(stock, recs))}
    assert wanted == {"S1": pytest.approx(140.0), "S2": pytest.approx(160.0)}

    requests = spark.createDataFrame(
        [("W", "A", "S1", 140.0), ("W", "A", "S2", 160.0), ("W", "B", "S1", 10.0), ("W", "C", "S1", 10.0), ("W", "D", "S1", 5.0)],
        "warehouse_id string, sku_id string, store_id string, request_qty double",
    )
    available = spark.createDataFrame([("W", "A", 150.0), ("W", "B", 99.0), ("W", "D", -4.0)], "warehouse_id string, sku_id string, on_hand_units double")
    got = {(r["sku_id"], r["store_id"]): r for r in rows(inventory.allocate_requests(requests, available))}
    assert got["A", "S1"]["approved_qty"] == 70 and got["A", "S2"]["approved_qty"] == 80
    assert got["A", "S1"]["decision_status"] == "Manual override" and got["B", "S1"]["decision_status"] == "Auto-approved"
    assert got["B", "S1"]["approved_qty"] == 10 and got["C", "S1"]["approved_qty"] == 0 and got["D", "S1"]["approved_qty"] == 0


def test_lost_sales_and_cover(spark):
    demand = spark.createDataFrame(
        [(day("2026-01-01"), "S", "A", 10, 7), (day("2026-01-02"), "S", "A", 5, 5)],
        "date date, store_id string, sku_id string, demand_units bigint, units_sold bigint",
    )
    skus = spark.createDataFrame([("A", 9.63)], "sku_id string, unit_price double")
    lost = one(inventory.lost_sales(demand, skus))
    assert (lost["lost_sales_units_estimate"], lost["lost_sales_revenue_estimate"]) == (3, 28.89)
    stats = spark.createDataFrame([("S", "A", 4.0)], "store_id string, sku_id string, demand_mean double")
    stock = snapshots(spark, [(day("2026-01-01"), "Store", "S", "A", 10.0, 0.0, 0.0, 0.0)])
    assert one(inventory.with_days_of_supply(stock, stats).select(F.col("computed_days_of_supply").alias("d")))["d"] == 2.5
