"""Staging casts, enriched sales and category marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.functions.banding import DEFAULTS, Thresholds
from stockloom.functions.columns import clip_low, rounded, safe_divide, share_true
from stockloom.operators.recent import newest_month, since


def _typed(df: DataFrame, **types: str) -> DataFrame:
    """Tolerant casts: text that does not fit the type becomes NULL instead of failing the job."""
    return df.select(*[F.col(name).try_cast(kind).alias(name) for name, kind in types.items()])


def staged_sales(sales: DataFrame) -> DataFrame:
    return (
        _typed(
            sales.withColumnRenamed("date", "sale_date"),
            sale_date="date",
            store_id="string",
            sku_id="string",
            units_sold="int",
            revenue="decimal(18,2)",
            promo_flag="boolean",
        )
        .where(F.col("units_sold") >= 0)
    )


def staged_inventory(snapshots: DataFrame) -> DataFrame:
    return _typed(
        snapshots.withColumnRenamed("date", "snapshot_date"),
        snapshot_date="date",
        location_type="string",
        location_id="string",
        sku_id="string",
        on_hand_units="double",
        on_order_units="double",
        days_of_supply="double",
    ).withColumn("on_hand_units", clip_low("on_hand_units", 0.0))


def enriched_sales(staged: DataFrame, skus: DataFrame, stores: DataFrame) -> DataFrame:
    """Sales with product and store attributes and revenue per unit."""
    return (
        staged.join(skus.select("sku_id", "category", "subcategory"), "sku_id")
        .join(stores.select("store_id", "region", "store_format"), "store_id")
        .select(
            "sale_date",
            "store_id",
            "sku_id",
            "category",
            "subcategory",
            "region",
            "store_format",
            "units_sold",
            "revenue",
            safe_divide("revenue", "units_sold").alias("revenue_per_unit"),
            "promo_flag",
        )
    )


def category_stock_mart(staged: DataFrame, skus: DataFrame, thresholds: Thresholds = DEFAULTS) -> DataFrame:
    """Rows, mean days of supply and excess share per category, store positions only.

    Snapshots are reduced to one row per SKU first, so the join with the categories sees aggregates.
    """
    per_sku = (
        staged.where(F.col("location_type") == "Store")
        .groupBy("sku_id")
        .agg(
            F.count("*").alias("n"),
            F.sum("days_of_supply").alias("dos"),
            F.count("days_of_supply").alias("dos_n"),
            F.count_if(F.col("days_of_supply") > thresholds.excess_days).alias("excess"),
        )
    )
    return (
        per_sku.join(skus.select("sku_id", "category"), "sku_id")
        .groupBy("category")
        .agg(
            F.sum("n").alias("snapshot_rows"),
            safe_divide(F.sum("dos"), F.sum("dos_n")).alias("avg_days_of_supply"),
            safe_divide(F.sum("excess"), F.sum("n")).alias("excess_stock_rate"),
        )
    )


def trailing_days(df: DataFrame, date: str, days: int, inclusive: bool = True) -> DataFrame:
    """Rows of the last ``days`` days before the newest date of the table (``>=`` or ``>``)."""
    start = newest_month(df).agg(F.date_sub(F.max(date), days).alias("d")).scalar()
    return since(df, date, start, inclusive)


def inventory_health(
    inventory: DataFrame, stockouts: DataFrame, products: DataFrame, days: int = 30, thresholds: Thresholds = DEFAULTS
) -> DataFrame:
    """Stock cover and recent stock-outs per category over the last ``days`` days of each fact table."""
    category = products.select("sku_id", "category")
    cover = (
        trailing_days(inventory, "date_key", days)
        .where(F.col("location_type") == "Store")
        .groupBy("sku_id")
        .agg(
            F.count("*").alias("n"),
            F.sum("days_of_supply").alias("dos"),
            F.count("days_of_supply").alias("dos_n"),
            F.count_if(F.col("days_of_supply") > thresholds.excess_days).alias("excess"),
        )
        .join(category, "sku_id")
        .groupBy("category")
        .agg(
            rounded(safe_divide(F.sum("dos"), F.sum("dos_n")), 1).alias("avg_days_of_supply"),
            rounded(safe_divide(F.sum("excess"), F.sum("n")) * 100, 1).alias("excess_stock_pct"),
        )
    )
    missed = (
        trailing_days(stockouts, "date_key", days)
        .where("stockout_flag")
        .groupBy("sku_id")
        .agg(F.count("*").alias("n"), F.sum("lost_sales_units_estimate").alias("units"))
        .join(category, "sku_id")
        .groupBy("category")
        .agg(F.sum("n").alias("days"), F.sum("units").alias("units"))
    )
    return (
        cover.join(missed, "category", "left")
        .select(
            "category",
            "avg_days_of_supply",
            "excess_stock_pct",
            F.coalesce("days", F.lit(0)).alias("stockout_days_last_30"),
            F.coalesce("units", F.lit(0)).alias("lost_sales_units_last_30"),
        )
        .orderBy(F.col("excess_stock_pct").desc(), "category")
    )
