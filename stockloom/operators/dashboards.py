"""Aggregates behind the eight report pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockloom.functions import accuracy
from stockloom.functions.banding import DEFAULTS, Thresholds, days_of_supply_band
from stockloom.functions.columns import month_start, rounded, safe_divide, week_start
from stockloom.operators import measures
from stockloom.operators.inventory import latest_snapshot
from stockloom.operators.panel import first_of_latest_weeks, latest_weeks


def _share(df: DataFrame, value: str) -> DataFrame:
    """Share in the total of a grouped table of a few rows (one per category); the window orders nothing larger."""
    return df.withColumn("share", safe_divide(value, F.sum(value).over(Window.partitionBy())))


# --- overview ---------------------------------------------------------------------------------------------------


def stockout_rate_by_region(sales: DataFrame, stockouts: DataFrame, stores: DataFrame) -> DataFrame:
    """Both facts are counted per store first; regions are joined to the counts."""
    place = stores.select("store_id", "region")
    days = sales.groupBy("store_id").agg(F.count("*").alias("store_sku_days"))
    misses = stockouts.where("stockout_flag").groupBy("store_id").agg(F.count("*").alias("stockout_days"))
    return (
        days.join(misses, "store_id", "left")
        .join(place, "store_id")
        .groupBy("region")
        .agg(
            F.sum("store_sku_days").alias("store_sku_days"),
            F.coalesce(F.sum("stockout_days"), F.lit(0)).alias("stockout_days"),
        )
        .withColumn("stockout_rate", safe_divide("stockout_days", "store_sku_days"))
    )


def inventory_value_by_category(inventory: DataFrame, products: DataFrame) -> DataFrame:
    """Value of the newest position of every location and SKU, with its share of the total."""
    value = (
        latest_snapshot(inventory, "date_key")
        .groupBy("sku_id")
        .agg(F.sum("on_hand_units").alias("units"))
        .join(products.select("sku_id", "category", "unit_cost"), "sku_id")
        .groupBy("category")
        .agg(F.sum(F.col("units") * F.col("unit_cost")).alias("inventory_value"))
    )
    return _share(value, "inventory_value")


# --- forecast accuracy ------------------------------------------------------------------------------------------


def error_trend(comparison: DataFrame) -> DataFrame:
    """Weekly WMAPE of baseline and champion side by side."""
    return comparison.groupBy("week").agg(
        accuracy.wmape("units_sold", "forecast_units_baseline").alias("wmape_baseline"),
        accuracy.wmape("units_sold", "forecast_units_advanced").alias("wmape_advanced"),
    )


def error_by_category(forecasts: DataFrame) -> DataFrame:
    return measures.forecast_measures(forecasts, ["category"])


# --- inventory --------------------------------------------------------------------------------------------------


def cover_heatmap(inventory: DataFrame, products: DataFrame, stores: DataFrame, regions: list[str]) -> DataFrame:
    """Mean days of supply, one row per category and one column per region, with the band of the category mean.

    The region list is given, so the pivot needs no extra job to find its columns.
    """
    cells = (
        inventory.where(F.col("location_type") == "Store")
        .groupBy("sku_id", F.col("location_id").alias("store_id"))
        .agg(F.sum("days_of_supply").alias("dos"), F.count("days_of_supply").alias("n"))
        .join(products.select("sku_id", "category"), "sku_id")
        .join(stores.select("store_id", "region"), "store_id")
        .select("category", "region", "dos", "n")
    )
    grid = cells.groupBy("category").agg(
        *[
            safe_divide(
                F.sum(F.when(F.col("region") == r, F.col("dos"))), F.sum(F.when(F.col("region") == r, F.col("n")))
            ).alias(r.lower().replace(" ", "_"))
            for r in regions
        ],
        safe_divide(F.sum("dos"), F.sum("n")).alias("all_regions"),
    )
    return grid.withColumn("band", days_of_supply_band("all_regions"))


def cover_band_composition(inventory: DataFrame, products: DataFrame) -> DataFrame:
    """Rows and share per category and days-of-supply band."""
    per_sku = (
        inventory.where(F.col("location_type") == "Store")
        .groupBy("sku_id", days_of_supply_band("days_of_supply").alias("band"))
        .agg(F.count("*").alias("n"))
    )
    cells = (
        per_sku.join(products.select("sku_id", "category"), "sku_id")
        .groupBy("category", "band")
        .agg(F.sum("n").alias("positions"))
    )
    whole = Window.partitionBy("category")
    return cells.withColumn("share", safe_divide("positions", F.sum("positions").over(whole)))


def anomaly_types(anomalies: DataFrame) -> DataFrame:
    return measures.anomaly_measures(anomalies, ["anomaly_type"])


# --- stock-outs -------------------------------------------------------------------------------------------------


def stockout_trend(sales: DataFrame, stockouts: DataFrame, weeks: int | None = 13) -> DataFrame:
    """Stock-out rate by week, the newest ``weeks`` weeks or all of them."""
    if weeks is not None:
        start = first_of_latest_weeks(sales, weeks, "date_key")
        sales, stockouts = (df.where(F.col("date_key") >= start) for df in (sales, stockouts))
    return measures.stockout_measures(
        sales.select(week_start("date_key").alias("week")),
        stockouts.select(week_start("date_key").alias("week"), "stockout_flag"),
        ["week"],
    ).withColumn("stockout_days", F.coalesce("stockout_days", F.lit(0)))


def at_risk_positions(inventory: DataFrame, recommendations: DataFrame, date: str = "date_key") -> DataFrame:
    """Newest store positions and whether stock on hand and on order is below the reorder point."""
    points = recommendations.groupBy("store_id", "sku_id").agg(F.max("reorder_point_units").alias("reorder_point_units"))
    stock = latest_snapshot(inventory.where(F.col("location_type") == "Store"), date)
    position = F.col("on_hand_units") + F.col("on_order_units")
    return (
        stock.withColumnRenamed("location_id", "store_id")
        .join(points, ["store_id", "sku_id"])
        .select(
            "store_id",
            "sku_id",
            position.alias("position_units"),
            "reorder_point_units",
            safe_divide("reorder_point_units", position).alias("risk_ratio"),
            (position < F.col("reorder_point_units")).alias("at_risk"),
        )
    )


def risk_by_category(positions: DataFrame, products: DataFrame) -> DataFrame:
    return (
        positions.join(products.select("sku_id", "category"), "sku_id")
        .groupBy("category")
        .agg(
            F.count("*").alias("positions"),
            F.count_if("at_risk").alias("at_risk_positions"),
            F.avg(F.when(F.col("at_risk"), 1.0).otherwise(0.0)).alias("risk_score"),
        )
    )


# --- replenishment ----------------------------------------------------------------------------------------------


def reorder_queue(requests: DataFrame) -> DataFrame:
    """Requests with the least cover first."""
    return requests.orderBy("days_of_supply", "store_id", "sku_id")


# --- suppliers --------------------------------------------------------------------------------------------------


def on_time_by_supplier(performance: DataFrame) -> DataFrame:
    return performance.select(
        "supplier_id",
        "supplier_name",
        "region_of_origin",
        (1 - F.col("late_rate")).alias("on_time_rate"),
        "avg_actual_lead_time_days",
        "reliability_score",
    )


def late_trend(orders: DataFrame, weeks: int | None = 13) -> DataFrame:
    shown = orders if weeks is None else latest_weeks(orders, weeks, "order_date")
    weekly = measures.order_measures(shown.select("*", week_start("order_date").alias("week")), ["week"])
    return weekly.select("week", "purchase_orders", "late_purchase_orders", "late_delivery_rate")


# --- promotions -------------------------------------------------------------------------------------------------


def promotion_mix(detail: DataFrame) -> DataFrame:
    return _share(detail.groupBy("category").agg(F.count("*").alias("events")), "events")


def variance_trend(detail: DataFrame) -> DataFrame:
    """Mean gap between uplift and plan by start month and promotion type."""
    gap = F.col("uplift_pct") - F.col("planned_uplift_pct")
    return detail.groupBy(month_start("start_date").alias("month"), "promo_type").agg(
        rounded(F.avg(gap), 4).alias("variance_pp"), F.count("*").alias("events")
    )


# --- monitoring -------------------------------------------------------------------------------------------------


def control_chart(performance: DataFrame, thresholds: Thresholds = DEFAULTS) -> DataFrame:
    """Weekly error against the warning and critical bounds."""
    return performance.select(
        "week",
        "wmape",
        F.lit(thresholds.wmape_warning).alias("warning_bound"),
        F.lit(thresholds.wmape_critical).alias("critical_bound"),
        "status",
    )
