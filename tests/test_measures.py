import pytest

from helpers import day, one, rows
from stockloom.operators import dashboards, measures


def monthly(spark):
    return spark.createDataFrame(
        [(day("2025-01-01"), 100.0), (day("2025-02-01"), 0.0), (day("2025-04-01"), 50.0), (day("2026-01-01"), 150.0)], "month date, u double"
    )


def test_periods_leave_gaps_empty(spark):
    got = {str(r["month"]): r for r in rows(measures.with_periods(monthly(spark), ["u"]))}
    assert got["2025-02-01"]["u_prior"] == 100.0 and got["2025-04-01"]["u_prior"] is None
    assert got["2026-01-01"]["u_last_year"] == 100.0 and got["2026-01-01"]["u_prior"] is None


def test_month_over_month_and_year_over_year(spark):
    mom = {str(r["month"]): r["u_mom_pct"] for r in rows(measures.month_over_month(monthly(spark), "u"))}
    assert mom["2025-02-01"] == -1.0 and mom["2025-04-01"] is None
    yoy = {str(r["month"]): r["u_yoy_delta"] for r in rows(measures.year_over_year_delta(monthly(spark), "u"))}
    assert yoy["2026-01-01"] == 50.0 and yoy["2025-01-01"] is None


def test_sales_measures_total_and_grouped(spark):
    df = spark.createDataFrame([("S", 10, 5.0, True), ("S", 30, None, False), ("T", 0, 1.0, False)], "store_id string, units_sold bigint, revenue double, promo_flag boolean")
    assert one(measures.sales_measures(df)) == {"units_sold": 40, "revenue": 6.0, "promo_units": 10, "promo_share": 0.25}
    assert {r["store_id"]: r["promo_share"] for r in rows(measures.sales_measures(df, ["store_id"]))} == {"S": 0.25, "T": None}


def test_stockout_measures(spark):
    sales = spark.createDataFrame([("S",), ("S",), ("T",)], "store_id string")
    outs = spark.createDataFrame([("S", True), ("S", False)], "store_id string, stockout_flag boolean")
    assert one(measures.stockout_measures(sales, outs)) == {"store_sku_days": 3, "stockout_days": 1, "stockout_rate": pytest.approx(1 / 3)}
    by = {r["store_id"]: r["stockout_rate"] for r in rows(measures.stockout_measures(sales, outs, ["store_id"]))}
    assert by == {"S": 0.5, "T": 0.0}


def test_order_and_decision_measures(spark):
    orders = spark.createDataFrame([(True, 5.0, 10.0), (False, 5.0, 0.0), (False, 10.0, 10.0), (False, 9.0, 10.0)], "is_late boolean, quantity_received double, quantity_ordered double")
    assert one(measures.order_measures(orders)) == {
        "purchase_orders": 4, "late_purchase_orders": 1, "avg_fill_rate": pytest.approx(0.8), "late_delivery_rate": 0.25, "supplier_status": "Watch",
    }
    decisions = spark.createDataFrame([("Auto-approved",), ("Manual override",)], "decision_status string")
    assert one(measures.decision_measures(decisions))["override_rate"] == 0.5


def test_turnover_divides_by_all_snapshots(spark):
    sales = spark.createDataFrame([("A", 10)], "sku_id string, units_sold bigint")
    stock = spark.createDataFrame([("A", 4.0), ("A", 6.0)], "sku_id string, on_hand_units double")
    products = spark.createDataFrame([("A", 2.0)], "sku_id string, unit_cost double")
    dates = spark.createDataFrame([(day("2026-01-01"),), (day("2026-01-11"),)], "date_key date")
    got = one(measures.turnover_measures(sales, stock, products, dates))
    assert got == {"inventory_value": 20.0, "cogs_annualised": 20 * 36.5, "inventory_turns": 36.5}
    single = one(measures.turnover_measures(sales, stock, products, dates.limit(1)))
    assert single["cogs_annualised"] is None


def test_kpi_selection(spark):
    table = measures.kpi_table(spark.range(1).selectExpr("0.1D as a", "9D as t"), {"Stockout Rate": "a", "Inventory Turns": "t"})
    assert one(measures.selected_kpi(table, "Stockout Rate"))["value"] == 0.1
    assert one(measures.selected_kpi(table, "unknown"))["value"] == 9.0
    assert one(measures.selected_kpi(table, None))["value"] == 9.0


def test_roles(spark):
    stores = spark.createDataFrame([("S", "N"), ("T", "E")], "store_id string, region string")
    facts = spark.createDataFrame([("S", 1), ("T", 2)], "store_id string, v int")

    def seen(role, allowed):
        return {r["v"] for r in rows(measures.restrict_fact(facts, stores, "store_id", role, allowed))}

    assert seen("Regional Planner", ["N"]) == {1} and seen("Regional Planner", []) == set()
    assert seen("Executive", []) == {1, 2}
    assert measures.apply_role(stores, "Regional Planner", ["E"]).count() == 1
    for role in ("Category Manager", "regional planner", "", None):
        with pytest.raises(ValueError):
            seen(role, ["X"])
        with pytest.raises(ValueError):
            measures.apply_role(stores, role, ["X"])


def test_location_has_two_roles(spark):
    stock = spark.createDataFrame([("Store", "X"), ("Warehouse", "X"), ("Store", "Y")], "location_type string, location_id string")
    stores = spark.createDataFrame([("X", "N")], "store_id string, region string")
    warehouses = spark.createDataFrame([("X", "S")], "warehouse_id string, region string")
    got = {(r["location_type"], r["location_id"]): r["region"] for r in rows(measures.with_location(stock, stores, warehouses))}
    assert got == {("Store", "X"): "N", ("Warehouse", "X"): "S", ("Store", "Y"): None}


def test_cover_pages(spark):
    stock = spark.createDataFrame(
        [("Store", "S", "A", 2.0), ("Store", "T", "A", 10.0), ("Store", "S", "B", 9.0), ("Warehouse", "W", "A", 99.0)],
        "location_type string, location_id string, sku_id string, days_of_supply double",
    )
    products = spark.createDataFrame([("A", "X"), ("B", "Y")], "sku_id string, category string")
    stores = spark.createDataFrame([("S", "NORTH"), ("T", "SOUTH WEST")], "store_id string, region string")
    grid = {r["category"]: r for r in rows(dashboards.cover_heatmap(stock, products, stores, ["NORTH", "SOUTH WEST"]))}
    assert grid["X"] == {"category": "X", "north": 2.0, "south_west": 10.0, "all_regions": 6.0, "band": "Normal"}
    assert grid["Y"]["south_west"] is None and grid["Y"]["band"] == "Elevated"
    bands = {(r["category"], r["band"]): r["share"] for r in rows(dashboards.cover_band_composition(stock, products))}
    assert bands == {("X", "Low"): 0.5, ("X", "Excess"): 0.5, ("Y", "Elevated"): 1.0}


def test_drift_quality_and_promotion_measures(spark):
    drift = spark.createDataFrame([(0.1,), (None,)], "psi double")
    assert one(measures.drift_measures(drift)) == {"max_feature_psi": 0.1, "drift_status": "Warning"}
    dq = spark.createDataFrame([(0.93, True), (0.93, False)], "pass_rate double, passed boolean")
    assert one(measures.quality_measures(dq)) == {"dq_pass_rate": 0.93, "dq_rules_failing": 1, "dq_status": "Warning"}
    up = spark.createDataFrame([(10.0, 15.0), (30.0, 15.0)], "uplift_pct double, planned_uplift_pct double")
    assert one(measures.promotion_measures(up))["uplift_variance_pp"] == 5.0
    assert one(measures.forecast_measures(spark.createDataFrame([(10, 12.0)], "units_sold int, forecast_units double")))["forecast_status"] == "Warning"
    assert one(measures.anomaly_measures(spark.range(3)))["inventory_anomalies"] == 3
    lost = spark.createDataFrame([(2, 10.0)], "lost_sales_units_estimate bigint, lost_sales_revenue_estimate double")
    dates = spark.createDataFrame([(day("2026-01-01"),), (day("2026-01-06"),)], "date_key date")
    assert one(measures.lost_sales_measures(lost, dates))["annualised_lost_sales"] == 730.0


def test_monthly_grouping(spark):
    df = spark.createDataFrame([(day("2026-01-05"), 1, 1.0, True), (day("2026-01-25"), 2, 1.0, True)], "date_key date, units_sold bigint, revenue double, promo_flag boolean")
    got = one(measures.by_month(df, measures.sales_measures, "date_key"))
    assert str(got["month"]) == "2026-01-01" and got["units_sold"] == 3
