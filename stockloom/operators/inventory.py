"""Demand statistics, stock policy, shock scenarios and store replenishment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.functions import stocking
from stockloom.functions.banding import DEFAULTS, Thresholds
from stockloom.functions.columns import rounded, safe_divide, share_true
from stockloom.operators.recent import newest_month, since

# Name, demand shock, lead-time shock.
SCENARIOS = [
    ("Baseline", 0.0, 0.0),
    ("Promotional demand surge (+35%)", 0.35, 0.0),
    ("Supplier disruption (+50% lead time)", 0.0, 0.50),
    ("Combined peak-season stress", 0.25, 0.30),
    ("Demand slowdown (-20%)", -0.20, 0.0),
]


def lead_time_statistics(purchase_orders: DataFrame, skus: DataFrame) -> DataFrame:
    """Quoted and observed lead time per supplier and SKU; orders for unknown SKUs do not count."""
    actual = F.datediff("actual_delivery_date", "order_date")
    quoted = F.datediff("expected_delivery_date", "order_date")
    stats = purchase_orders.groupBy("supplier_id", "sku_id").agg(
        rounded(F.avg(quoted), 1).alias("quoted_lead_time_days"),
        rounded(F.avg(actual), 1).alias("observed_avg_lead_time_days"),
        rounded(F.coalesce(F.stddev_pop(actual), F.lit(0.0)), 2).alias("observed_std_lead_time_days"),
        rounded(share_true(F.col("actual_delivery_date") <= F.col("expected_delivery_date")), 3).alias("on_time_rate"),
        F.count("*").alias("sample_size"),
    )
    return stats.join(skus.select("sku_id"), "sku_id", "left_semi").select(
        "supplier_id",
        "sku_id",
        "quoted_lead_time_days",
        "observed_avg_lead_time_days",
        "observed_std_lead_time_days",
        "on_time_rate",
        "sample_size",
    )


def demand_statistics(
    sales: DataFrame, days: int = 56, keys: tuple[str, ...] = ("store_id", "sku_id"), date: str = "date"
) -> DataFrame:
    """Mean and sample deviation of daily units over the last ``days`` days; a lone day gets 30 % of its mean."""
    last = newest_month(sales).agg(F.date_sub(F.max(date), days).alias("d")).scalar()
    mean = F.avg("units_sold")
    return (
        since(sales, date, last, inclusive=False)
        .groupBy(*keys)
        .agg(mean.alias("demand_mean"), F.coalesce(F.stddev_samp("units_sold"), mean * 0.3).alias("demand_std"))
    )


def reorder_recommendations(
    demand_stats: DataFrame,
    lead_times: DataFrame,
    skus: DataFrame,
    thresholds: Thresholds = DEFAULTS,
    holding_base: str = "demand",
    category_z: DataFrame | None = None,
) -> DataFrame:
    """Safety stock, reorder point and order size per store, SKU and supplier of the SKU.

    ``holding_base="demand"`` charges the holding rate on daily demand, ``"unit_cost"`` on the cost of the unit.
    ``category_z`` (category, z) replaces the single service-level factor.
    """
    columns = ["sku_id"] + (["category"] if category_z is not None else [])
    columns += ["unit_cost"] if holding_base == "unit_cost" else []
    observed = lead_times.select(
        "sku_id", "supplier_id", "observed_avg_lead_time_days", "observed_std_lead_time_days", "on_time_rate"
    )
    sourcing = skus.select(*columns).join(observed, "sku_id", "left")
    series = demand_stats.join(sourcing, "sku_id", "left")
    if category_z is not None:
        series = series.join(category_z.select("category", F.col("z").alias("category_z")), "category", "left")

    # The fallback lead time is the median over the joined rows. Counting series per SKU first gives the same median
    # without joining twice.
    weights = demand_stats.groupBy("sku_id").agg(F.count("*").alias("series"))
    median = (
        skus.select("sku_id")
        .join(lead_times, "sku_id")
        .join(weights, "sku_id")
        .agg(F.percentile("observed_avg_lead_time_days", F.lit(0.5), F.col("series")).alias("m"))
        .scalar()
    )
    z = F.lit(thresholds.service_level_z)
    z = F.coalesce(F.col("category_z"), z) if category_z is not None else z
    series = (
        series.withColumn("lead", F.coalesce("observed_avg_lead_time_days", median))
        .withColumn("lead_std", F.coalesce("observed_std_lead_time_days", F.lit(1.5)))
        .withColumn("z", z)
        .withColumn("ss", stocking.safety_stock("demand_mean", "demand_std", "lead", "lead_std", "z"))
    )
    base = F.greatest(F.col("demand_mean"), F.lit(0.1)) if holding_base == "demand" else F.col("unit_cost")
    eoq = stocking.economic_order_quantity(
        F.col("demand_mean") * 365, F.lit(thresholds.order_cost), base * thresholds.holding_rate
    )
    return series.select(
        "store_id",
        "sku_id",
        rounded("demand_mean", 2).alias("demand_mean_daily"),
        rounded("demand_std", 2).alias("demand_std_daily"),
        rounded("lead", 1).alias("lead_time_days"),
        rounded("lead_std", 2).alias("lead_time_std_days"),
        F.col("z").alias("service_level_z"),
        rounded("ss", 1).alias("safety_stock_units"),
        rounded(stocking.reorder_point("demand_mean", "lead", "ss"), 1).alias("reorder_point_units"),
        rounded(eoq, 0).alias("economic_order_qty_units"),
        F.col("on_time_rate").alias("supplier_on_time_rate"),
    )


def _shocked(recs: DataFrame, demand: Column, lead: Column, z: float) -> DataFrame:
    up, down = F.greatest(demand, F.lit(0.0)), F.abs(F.least(demand, F.lit(0.0)))
    return (
        recs.withColumn("demand_mean_daily", F.col("demand_mean_daily") * (1 + demand))
        .withColumn("demand_std_daily", F.col("demand_std_daily") * (1 + up * 0.6 + down * 0.3))
        .withColumn("lead_time_days", F.col("lead_time_days") * (1 + lead))
        .withColumn("lead_time_std_days", F.col("lead_time_std_days") * (1 + F.greatest(lead, F.lit(0.0)) * 0.8))
        .withColumn(
            "ss",
            stocking.safety_stock(
                "demand_mean_daily", "demand_std_daily", "lead_time_days", "lead_time_std_days", F.lit(z)
            ),
        )
        .withColumn("safety_stock_units", rounded("ss", 1))
        .withColumn(
            "reorder_point_units", rounded(stocking.reorder_point("demand_mean_daily", "lead_time_days", "ss"), 1)
        )
        .drop("ss")
    )


def apply_scenario(
    recommendations: DataFrame, demand_shock: float = 0.0, lead_shock: float = 0.0, z: float = DEFAULTS.service_level_z
) -> DataFrame:
    """Recommendations recomputed from their published (rounded) columns under one shock."""
    return _shocked(recommendations, F.lit(float(demand_shock)), F.lit(float(lead_shock)), z)


def run_scenarios(
    recommendations: DataFrame, scenarios=SCENARIOS, z: float = DEFAULTS.service_level_z
) -> DataFrame:
    """Average and total stock needs under every named shock, in one pass over the recommendations."""
    cases = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(name).alias("scenario"),
                F.lit(float(d)).alias("demand_shock_pct"),
                F.lit(float(lt)).alias("lead_time_shock_pct"),
            )
            for i, (name, d, lt) in enumerate(scenarios)
        ]
    )
    wide = recommendations.select("*", F.inline(cases))
    shocked = _shocked(wide, F.col("demand_shock_pct"), F.col("lead_time_shock_pct"), z)
    return (
        shocked.groupBy("position", "scenario", "demand_shock_pct", "lead_time_shock_pct")
        .agg(
            rounded(F.avg("safety_stock_units"), 1).alias("avg_safety_stock_units"),
            rounded(F.avg("reorder_point_units"), 1).alias("avg_reorder_point_units"),
            # published on one decimal, so the total is added up as decimals and is exact in any order
            F.round(F.sum(F.col("safety_stock_units").cast("decimal(28,1)")), 0).cast("double").alias(
                "total_safety_stock_units"
            ),
        )
        .orderBy("position")
        .drop("position")
    )


def latest_snapshot(snapshots: DataFrame, date: str = "date") -> DataFrame:
    """Newest stock position per location and SKU.

    A plain hash aggregate with map-side combine: no group is gathered and sorted. All columns follow the same date, so
    they come from the same row.
    """
    values = ["on_hand_units", "on_order_units", "safety_stock_units", "days_of_supply"]
    return snapshots.groupBy("location_type", "location_id", "sku_id").agg(
        F.max(date).alias("snapshot_date"), *[F.max_by(c, date).alias(c) for c in values]
    )


def replenishment_requests(
    snapshots: DataFrame, recommendations: DataFrame, date: str = "date", target_factor: float = 1.7
) -> DataFrame:
    """Store positions below their reorder point and the quantity that lifts them to target.

    A SKU with several suppliers is judged by its highest reorder point.
    """
    points = recommendations.groupBy("store_id", "sku_id").agg(
        F.max("reorder_point_units").alias("reorder_point_units")
    )
    stock = latest_snapshot(snapshots.where(F.col("location_type") == "Store"), date)
    position = F.col("on_hand_units") + F.col("on_order_units")
    request = F.col("reorder_point_units") * target_factor - position
    return (
        stock.withColumnRenamed("location_id", "store_id")
        .join(points, ["store_id", "sku_id"])
        .where(position < F.col("reorder_point_units"))
        .select(
            "store_id",
            "sku_id",
            "snapshot_date",
            "on_hand_units",
            "on_order_units",
            "days_of_supply",
            "reorder_point_units",
            F.greatest(request, F.lit(0.0)).alias("request_qty"),
        )
        .where(F.col("request_qty") > 0)
    )


def allocate_requests(requests: DataFrame, available: DataFrame, auto_fill: float = 0.98) -> DataFrame:
    """Share short warehouse stock among store requests in proportion to what they asked for.

    ``requests``: warehouse_id, sku_id, store_id, request_qty. ``available``: warehouse_id, sku_id, on_hand_units.
    """
    keys = ["warehouse_id", "sku_id"]
    totals = requests.groupBy(*keys).agg(F.sum("request_qty").alias("total_request"))
    stock = F.greatest(F.coalesce(F.col("on_hand_units"), F.lit(0.0)), F.lit(0.0))
    ratios = totals.join(available.select(*keys, "on_hand_units"), keys, "left").select(
        *keys,
        "total_request",
        F.least(F.lit(1.0), F.coalesce(safe_divide(stock, "total_request"), F.lit(0.0))).alias("fill_ratio"),
    )
    auto = F.col("fill_ratio") >= auto_fill
    return requests.join(ratios, keys).select(
        *keys,
        "store_id",
        "request_qty",
        "fill_ratio",
        (F.col("request_qty") * F.col("fill_ratio")).alias("approved_qty"),
        F.when(auto, "System Auto-Replenishment").otherwise("Planner Review").alias("approver"),
        (~auto).alias("override_flag"),
        F.when(auto, "").otherwise("Warehouse supply shortfall - partial fulfilment").alias("override_reason"),
        F.when(auto, "Auto-approved").otherwise("Manual override").alias("decision_status"),
    )


def with_days_of_supply(snapshots: DataFrame, demand_stats: DataFrame) -> DataFrame:
    """Store snapshots with days of supply from observed demand."""
    return (
        snapshots.where(F.col("location_type") == "Store")
        .join(
            demand_stats.select(F.col("store_id").alias("location_id"), "sku_id", "demand_mean"),
            ["location_id", "sku_id"],
        )
        .withColumn("computed_days_of_supply", stocking.days_of_supply("on_hand_units", "demand_mean"))
    )


def lost_sales(demand: DataFrame, skus: DataFrame) -> DataFrame:
    """Unmet demand valued at the shelf price. ``demand``: date, store_id, sku_id, demand_units, units_sold."""
    lost = (F.col("demand_units") - F.col("units_sold")).cast("bigint")
    return (
        demand.withColumn("lost_sales_units_estimate", lost)
        .where(F.col("lost_sales_units_estimate") > 0)
        .join(skus.select("sku_id", "unit_price"), "sku_id")
        .select(
            "date",
            "store_id",
            "sku_id",
            F.lit(True).alias("stockout_flag"),
            "lost_sales_units_estimate",
            rounded(F.col("lost_sales_units_estimate") * F.col("unit_price"), 2).alias("lost_sales_revenue_estimate"),
        )
    )
