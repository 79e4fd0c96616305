"""Raw extracts to cleaned tables: orphan removal, de-duplication, repair, clipping and imputation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.functions.banding import DEFAULTS, Thresholds
from stockloom.functions.columns import clip_low

PASS_THROUGH = [
    "warehouses",
    "suppliers",
    "lead_times",
    "promotions",
    "prices",
    "markdowns",
    "holidays",
    "returns",
    "stock_outs",
    "replenishment_decisions",
]


def clean_products(products: DataFrame) -> DataFrame:
    return products.where(F.col("product_id").isNotNull())


def drop_orphans(rows: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose key exists in the parent; a semi join, so repeated parent keys cannot multiply rows."""
    return rows.join(parent.select(key), key, "left_semi").select(*rows.columns)


def clean_sales(sales: DataFrame, skus: DataFrame, thresholds: Thresholds = DEFAULTS) -> DataFrame:
    """Known SKUs only, missing revenue from the shelf price, exact copies removed, implausible volumes flagged."""
    priced = sales.join(skus.select("sku_id", "unit_price"), "sku_id")
    return priced.select(
        "date",
        "store_id",
        "sku_id",
        "units_sold",
        F.coalesce(F.col("revenue"), F.col("units_sold") * F.col("unit_price")).alias("revenue"),
        "promo_flag",
        (F.col("units_sold") >= thresholds.volume_outlier_units).alias("is_volume_outlier"),
    ).distinct()


def clean_inventory(snapshots: DataFrame) -> DataFrame:
    """Negative stock becomes zero and stays marked."""
    return snapshots.select(
        "date",
        "location_type",
        "location_id",
        "sku_id",
        clip_low("on_hand_units", 0.0).alias("on_hand_units"),
        "on_order_units",
        "safety_stock_units",
        "days_of_supply",
        (F.col("on_hand_units") < 0).alias("had_negative_on_hand_defect"),
    )


def impute_by_group_mean(df: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """Missing values become the mean of their group.

    The means are an aggregate joined back, not a window: a group holding a large part of the rows is pre-aggregated
    on the map side instead of being gathered in one task.
    """
    means = df.groupBy(F.col(group).alias("g")).agg(*[F.avg(c).alias(f"mean_{c}") for c in columns])
    joined = df.join(means, F.col(group).eqNullSafe(F.col("g")), "left")
    return joined.select(
        *[F.coalesce(c, f"mean_{c}").alias(c) if c in columns else F.col(c) for c in df.columns]
    )


def build_silver(raw: Mapping[str, DataFrame], thresholds: Thresholds = DEFAULTS) -> dict[str, DataFrame]:
    skus = drop_orphans(raw["skus"], raw["products"], "product_id")
    silver = {
        "products": clean_products(raw["products"]),
        "skus": skus,
        "stores": drop_orphans(raw["stores"], raw["warehouses"], "warehouse_id"),
        "daily_sales": clean_sales(raw["daily_sales"], skus, thresholds),
        "inventory_snapshots": clean_inventory(raw["inventory_snapshots"]),
        "purchase_orders": drop_orphans(raw["purchase_orders"], skus, "sku_id"),
        "weather": impute_by_group_mean(raw["weather"], "region", ["avg_temp_c", "precipitation_mm"]),
    }
    silver.update({name: raw[name] for name in PASS_THROUGH})
    return silver
