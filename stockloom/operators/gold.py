"""Star schema and the supplier mart."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.functions.banding import DEFAULTS, Thresholds, delivery_band
from stockloom.functions.columns import as_date, rounded, safe_divide, share_true, sunday_based_weekday


def calendar(first: F.Column, last: F.Column, source: DataFrame) -> DataFrame:
    """One row per day between two aggregates of ``source``."""
    d = F.col("date_key")
    return (
        source.agg(F.sequence(first, last).alias("days"))
        .select(F.explode("days").alias("date_key"))
        .select(
            "date_key",
            F.year(d).alias("year"),
            F.month(d).alias("month"),
            F.weekofyear(d).alias("iso_week"),
            sunday_based_weekday(d).alias("day_of_week"),
            F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        )
    )


def dim_date(sales: DataFrame) -> DataFrame:
    return calendar(as_date(F.min("date")), as_date(F.max("date")), sales)


def dim_product(skus: DataFrame, products: DataFrame) -> DataFrame:
    own = skus.select("sku_id", "product_id", "pack_size", "uom", "unit_cost", "unit_price", "discontinued")
    shared = products.select(
        "product_id", "category", "subcategory", "brand", "shelf_life_days", "is_seasonal"
    )
    return own.join(shared, "product_id").select(
        "sku_id",
        "product_id",
        "category",
        "subcategory",
        "brand",
        "pack_size",
        "uom",
        "unit_cost",
        "unit_price",
        "shelf_life_days",
        "is_seasonal",
        "discontinued",
    )


def dim_store(stores: DataFrame) -> DataFrame:
    return stores.select("store_id", "region", "warehouse_id", "store_format", "size_sqm", "open_date")


def _dated(df: DataFrame, *rest: str) -> DataFrame:
    return df.select(as_date("date").alias("date_key"), *rest)


def fact_daily_sales(sales: DataFrame) -> DataFrame:
    return _dated(sales, "store_id", "sku_id", "units_sold", "revenue", "promo_flag", "is_volume_outlier")


def fact_inventory(snapshots: DataFrame) -> DataFrame:
    return _dated(
        snapshots,
        "location_type",
        "location_id",
        "sku_id",
        "on_hand_units",
        "on_order_units",
        "safety_stock_units",
        "days_of_supply",
        "had_negative_on_hand_defect",
    )


def fact_purchase_orders(orders: DataFrame) -> DataFrame:
    dates = ["order_date", "expected_delivery_date", "actual_delivery_date"]
    kept = ["po_id", "supplier_id", "sku_id", "warehouse_id"]
    rest = ["quantity_ordered", "quantity_received", "unit_cost", "status"]
    late = as_date("actual_delivery_date") > as_date("expected_delivery_date")
    return orders.select(*kept, *[as_date(d).alias(d) for d in dates], *rest, late.alias("is_late"))


def fact_stockouts(stock_outs: DataFrame) -> DataFrame:
    return _dated(
        stock_outs,
        "store_id",
        "sku_id",
        "stockout_flag",
        "lost_sales_units_estimate",
        "lost_sales_revenue_estimate",
    )


def fact_replenishment_decisions(decisions: DataFrame) -> DataFrame:
    rest = [c for c in decisions.columns if c not in ("decision_id", "date")]
    return decisions.select("decision_id", as_date("date").alias("date_key"), *rest)


def supplier_performance(orders: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Delivery mart. Orders are reduced to one row per supplier before the supplier attributes are joined."""
    lead = F.datediff("actual_delivery_date", "order_date")
    stats = orders.groupBy("supplier_id").agg(
        F.count("*").alias("purchase_orders"),
        share_true("is_late").alias("late_rate"),
        F.avg(lead).alias("avg_actual_lead_time_days"),
        F.avg(safe_divide("quantity_received", "quantity_ordered")).alias("avg_fill_rate"),
    )
    who = suppliers.select("supplier_id", "supplier_name", "reliability_score", "region_of_origin")
    return who.join(stats, "supplier_id")


def supplier_scorecard(performance: DataFrame, thresholds: Thresholds = DEFAULTS) -> DataFrame:
    """Published scorecard, worst delivery first."""
    return performance.orderBy(F.col("late_rate").desc(), "supplier_id").select(
        "supplier_id",
        "supplier_name",
        "region_of_origin",
        "reliability_score",
        "purchase_orders",
        rounded(F.col("late_rate") * 100, 1).alias("late_rate_pct"),
        rounded("avg_actual_lead_time_days", 1).alias("avg_actual_lead_time_days"),
        rounded(F.col("avg_fill_rate") * 100, 1).alias("avg_fill_rate_pct"),
        delivery_band("late_rate", thresholds).alias("delivery_status"),
    )


def worst_suppliers(performance: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` suppliers with the highest late rate (a top-k report)."""
    return performance.orderBy(F.col("late_rate").desc(), "supplier_id").limit(n)


def build_gold(silver: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    orders = fact_purchase_orders(silver["purchase_orders"])
    return {
        "dim_date": dim_date(silver["daily_sales"]),
        "dim_product": dim_product(silver["skus"], silver["products"]),
        "dim_store": dim_store(silver["stores"]),
        "dim_warehouse": silver["warehouses"],
        "dim_supplier": silver["suppliers"],
        "fact_daily_sales": fact_daily_sales(silver["daily_sales"]),
        "fact_inventory": fact_inventory(silver["inventory_snapshots"]),
        "fact_purchase_orders": orders,
        "fact_stockouts": fact_stockouts(silver["stock_outs"]),
        "fact_replenishment_decisions": fact_replenishment_decisions(silver["replenishment_decisions"]),
        "supplier_performance": supplier_performance(orders, silver["suppliers"]),
    }
