"""Business KPIs with their targets and the value estimate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.functions.banding import DEFAULTS, Thresholds
from stockloom.functions.columns import clip_low, rounded, safe_divide


@dataclass(frozen=True)
class Targets:
    """Improvement targets and effort baseline. Fixed values."""

    stockout_rate_reduction_low: float = 0.10
    stockout_rate_reduction_high: float = 0.20
    excess_inventory_reduction_low: float = 0.08
    excess_inventory_reduction_high: float = 0.15
    forecast_accuracy_improvement: float = 0.10
    inventory_turns_improvement: float = 0.05
    manual_effort_reduction: float = 0.20
    planner_hours_per_month: float = 120
    planner_cost_per_hour: float = 65


TARGETS = Targets()
PUBLISHED_TARGETS = (
    "stockout_rate_reduction_low",
    "stockout_rate_reduction_high",
    "excess_inventory_reduction_low",
    "excess_inventory_reduction_high",
    "forecast_accuracy_improvement",
    "inventory_turns_improvement",
    "manual_effort_reduction",
)


def _one(df: DataFrame, **columns: Column) -> Column:
    """Several aggregates of one table as a single scalar struct."""
    return df.agg(F.struct(*[c.alias(n) for n, c in columns.items()]).alias("s")).scalar()


def mean_inventory_value(snapshots: DataFrame, skus: DataFrame, date: str = "date") -> DataFrame:
    """Stock value of the stores per day, averaged over days: one row ``value``.

    Units are added per day and SKU before the cost is joined.
    """
    units = (
        snapshots.where(F.col("location_type") == "Store")
        .groupBy(date, "sku_id")
        .agg(F.sum(clip_low("on_hand_units", 0.0)).alias("units"))
    )
    daily = (
        units.join(skus.select("sku_id", "unit_cost"), "sku_id", "left")
        .groupBy(date)
        .agg(F.coalesce(F.sum(F.col("units") * F.col("unit_cost")), F.lit(0.0)).alias("value"))
    )
    return daily.agg(F.avg("value").alias("value"))


def sales_totals(sales: DataFrame, skus: DataFrame, date: str = "date") -> DataFrame:
    """Rows, cost of goods sold and length of history in days (1 at least): one row."""
    per_sku = sales.groupBy("sku_id").agg(
        F.count("*").alias("n"),
        F.sum("units_sold").alias("units"),
        F.min(date).alias("first"),
        F.max(date).alias("last"),
    )
    return per_sku.join(skus.select("sku_id", "unit_cost"), "sku_id", "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.sum(F.col("units") * F.col("unit_cost")).alias("cogs"),
        F.greatest(F.datediff(F.max("last"), F.min("first")), F.lit(1)).alias("days"),
    )


def business_kpis(
    sales: DataFrame,
    stock_outs: DataFrame,
    snapshots: DataFrame,
    skus: DataFrame,
    quality: DataFrame,
    overrides: DataFrame,
    improvement: DataFrame | None = None,
    thresholds: Thresholds = DEFAULTS,
    targets: Targets = TARGETS,
) -> DataFrame:
    """One row of headline KPIs and their targets.

    Each table is reduced on its own to a scalar; the row is put together without a join.
    """
    spark = sales.sparkSession
    sold = sales_totals(sales, skus).agg(
        F.struct(F.max("n").alias("n"), F.max("cogs").alias("cogs"), F.max("days").alias("days")).alias("s")
    ).scalar()
    lost = _one(
        stock_outs, n=F.count("*"), revenue=F.coalesce(F.sum("lost_sales_revenue_estimate"), F.lit(0.0))
    )
    store_rows = snapshots.where(F.col("location_type") == "Store")
    excess = _one(
        store_rows,
        rate=F.avg(F.when(F.col("days_of_supply") > thresholds.excess_days, 1.0).otherwise(0.0)),
    )
    value = mean_inventory_value(snapshots, skus).scalar()
    error = improvement if improvement is not None else None
    errors = (
        _one(
            error,
            base=F.max("baseline_wmape"),
            advanced=F.max("advanced_wmape"),
            gain=F.max("relative_improvement_pct"),
        )
        if error is not None
        else None
    )
    nothing = F.lit(None).cast("double")
    raw = spark.range(1).select(
        safe_divide(lost.getField("n"), sold.getField("n")).alias("stockout"),
        excess.getField("rate").alias("excess"),
        safe_divide(sold.getField("cogs") * 365, sold.getField("days")).alias("cogs"),
        safe_divide(lost.getField("revenue") * 365, sold.getField("days")).alias("lost"),
        value.alias("inventory_value"),
        (errors.getField("base") if errors is not None else nothing).alias("wmape_base"),
        (errors.getField("advanced") if errors is not None else nothing).alias("wmape_advanced"),
        (errors.getField("gain") if errors is not None else nothing).alias("gain"),
        overrides.agg(F.max("override_rate").alias("r")).scalar().alias("override_rate"),
        quality.agg(F.avg("pass_rate").alias("r")).scalar().alias("dq"),
    )
    turns = safe_divide("cogs", "inventory_value")
    return raw.select(
        rounded("stockout", 4).alias("stockout_rate_baseline"),
        rounded(F.col("stockout") * (1 - targets.stockout_rate_reduction_high), 4).alias("stockout_rate_target"),
        rounded("excess", 4).alias("excess_inventory_rate_baseline"),
        rounded(F.col("excess") * (1 - targets.excess_inventory_reduction_high), 4).alias(
            "excess_inventory_rate_target"
        ),
        rounded(turns, 2).alias("inventory_turns_baseline"),
        rounded(turns * (1 + targets.inventory_turns_improvement), 2).alias("inventory_turns_target"),
        F.col("wmape_base").alias("forecast_wmape_baseline"),
        F.col("wmape_advanced").alias("forecast_wmape_advanced"),
        F.col("gain").alias("forecast_accuracy_relative_improvement_pct"),
        F.col("override_rate").alias("manual_override_rate_baseline"),
        rounded("dq", 4).alias("data_quality_pass_rate"),
        rounded("cogs", 0).alias("annualised_cogs_estimate_aud"),
        rounded("lost", 0).alias("annual_lost_sales_estimate_aud"),
        rounded("inventory_value", 2).alias("mean_inventory_value_aud"),
        F.struct(*[F.lit(float(getattr(targets, n))).alias(n) for n in PUBLISHED_TARGETS]).alias("targets"),
    )


def value_estimate(kpis: DataFrame, thresholds: Thresholds = DEFAULTS, targets: Targets = TARGETS) -> DataFrame:
    """Yearly value band: recovered sales, carrying cost of freed stock and planner time."""
    lost, stock = F.col("annual_lost_sales_estimate_aud"), F.col("mean_inventory_value_aud")
    freed = stock * F.col("excess_inventory_rate_baseline")
    hours = targets.planner_hours_per_month * targets.manual_effort_reduction
    return kpis.select(
        rounded(lost * targets.stockout_rate_reduction_low, 2).alias("recovered_sales_low"),
        rounded(lost * targets.stockout_rate_reduction_high, 2).alias("recovered_sales_high"),
        rounded(freed * targets.excess_inventory_reduction_low * thresholds.holding_rate, 2).alias(
            "carrying_cost_saved_low"
        ),
        rounded(freed * targets.excess_inventory_reduction_high * thresholds.holding_rate, 2).alias(
            "carrying_cost_saved_high"
        ),
        F.lit(float(hours)).alias("planner_hours_freed_per_month"),
        F.lit(float(hours * 12 * targets.planner_cost_per_hour)).alias("planner_value_per_year"),
    )
