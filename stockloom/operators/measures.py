"""Report measures over the star schema, for any grouping.

``by`` names grouping columns of the (already filtered or enriched) fact; without it a measure is one total row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.functions import accuracy
from stockloom.functions.banding import (
    DEFAULTS,
    Thresholds,
    delivery_band,
    drift_status,
    pass_rate_status_strict,
    wmape_status,
)
from stockloom.functions.columns import count_true, safe_divide

By = Sequence[str]


def _grouped(df: DataFrame, by: By, *aggregates: Column) -> DataFrame:
    return df.groupBy(*by).agg(*aggregates)


def sales_measures(sales: DataFrame, by: By = ()) -> DataFrame:
    """Units, revenue, promoted units and their share."""
    return _grouped(
        sales,
        by,
        F.sum("units_sold").alias("units_sold"),
        F.sum("revenue").alias("revenue"),
        F.sum(F.when(F.col("promo_flag"), F.col("units_sold"))).alias("promo_units"),
    ).withColumn("promo_share", safe_divide("promo_units", "units_sold"))


def _beside(left: DataFrame, right: DataFrame, by: By) -> DataFrame:
    """Two aggregates side by side: joined on the grouping columns, or as totals when there are none."""
    if by:
        return left.join(right, list(by), "left")
    return left.select("*", *[right.select(c).scalar().alias(c) for c in right.columns])


def stockout_measures(sales: DataFrame, stockouts: DataFrame, by: By = ()) -> DataFrame:
    """Store-SKU days sold, stock-out days and their rate."""
    days = _grouped(sales, by, F.count("*").alias("store_sku_days"))
    misses = _grouped(stockouts, by, count_true("stockout_flag").alias("stockout_days"))
    return _beside(days, misses, by).withColumn(
        "stockout_rate", safe_divide(F.coalesce("stockout_days", F.lit(0)), "store_sku_days")
    )


def calendar_days(dates: DataFrame) -> Column:
    """Days between the first and the last date of the calendar."""
    return dates.agg(F.datediff(F.max("date_key"), F.min("date_key")).alias("d")).scalar()


def lost_sales_measures(stockouts: DataFrame, dates: DataFrame, by: By = ()) -> DataFrame:
    return _grouped(
        stockouts,
        by,
        F.sum("lost_sales_units_estimate").alias("lost_sales_units"),
        F.sum("lost_sales_revenue_estimate").alias("lost_sales_revenue"),
    ).withColumn(
        "annualised_lost_sales", F.col("lost_sales_revenue") * safe_divide(F.lit(365), calendar_days(dates))
    )


def stock_measures(inventory: DataFrame, by: By = (), thresholds: Thresholds = DEFAULTS) -> DataFrame:
    """Mean days of supply over all locations, excess rows and their rate over store rows."""
    store = F.col("location_type") == "Store"
    return _grouped(
        inventory,
        by,
        F.avg("days_of_supply").alias("avg_days_of_supply"),
        count_true(store & (F.col("days_of_supply") > thresholds.excess_days)).alias("excess_stock_rows"),
        count_true(store).alias("store_inventory_rows"),
    ).withColumn("excess_inventory_rate", safe_divide("excess_stock_rows", "store_inventory_rows"))


def turnover_measures(
    sales: DataFrame, inventory: DataFrame, products: DataFrame, dates: DataFrame, by: By = ()
) -> DataFrame:
    """Stock value summed over all snapshots, yearly cost of goods sold and their ratio.

    Both facts are reduced per SKU before the cost is joined; ``by`` may use product columns.
    """
    cost = products.select("sku_id", "unit_cost", *by)
    stock = (
        inventory.groupBy("sku_id")
        .agg(F.sum("on_hand_units").alias("units"))
        .join(cost, "sku_id")
        .groupBy(*by)
        .agg(F.sum(F.col("units") * F.col("unit_cost")).alias("inventory_value"))
    )
    sold = (
        sales.groupBy("sku_id")
        .agg(F.sum("units_sold").alias("units"))
        .join(cost, "sku_id")
        .groupBy(*by)
        .agg(F.sum(F.col("units") * F.col("unit_cost")).alias("cogs"))
    )
    return (
        _beside(stock, sold, by)
        .withColumn("cogs_annualised", F.col("cogs") * safe_divide(F.lit(365), calendar_days(dates)))
        .withColumn("inventory_turns", safe_divide("cogs_annualised", "inventory_value"))
        .drop("cogs")
    )


def order_measures(orders: DataFrame, by: By = (), thresholds: Thresholds = DEFAULTS) -> DataFrame:
    """Orders, late orders, late rate, mean of the row-wise fill rates and the supplier status."""
    return (
        _grouped(
            orders,
            by,
            F.count("*").alias("purchase_orders"),
            count_true("is_late").alias("late_purchase_orders"),
            F.avg(safe_divide("quantity_received", "quantity_ordered")).alias("avg_fill_rate"),
        )
        .withColumn("late_delivery_rate", safe_divide("late_purchase_orders", "purchase_orders"))
        .withColumn("supplier_status", delivery_band("late_delivery_rate", thresholds))
    )


def decision_measures(decisions: DataFrame, by: By = ()) -> DataFrame:
    rate = safe_divide("auto_approved_decisions", "replenishment_decisions")
    return (
        _grouped(
            decisions,
            by,
            F.count("*").alias("replenishment_decisions"),
            count_true(F.col("decision_status") == "Auto-approved").alias("auto_approved_decisions"),
        )
        .withColumn("auto_approved_rate", rate)
        .withColumn("override_rate", 1 - F.col("auto_approved_rate"))
    )


def forecast_measures(
    forecasts: DataFrame,
    by: By = (),
    actual: str = "units_sold",
    forecast: str = "forecast_units",
    thresholds: Thresholds = DEFAULTS,
) -> DataFrame:
    return (
        _grouped(
            forecasts,
            by,
            accuracy.wmape(actual, forecast).alias("wmape"),
            accuracy.bias(actual, forecast).alias("forecast_bias"),
        )
        .withColumn("forecast_accuracy_pct", (1 - F.col("wmape")) * 100)
        .withColumn("forecast_status", wmape_status("wmape", thresholds))
    )


def drift_measures(drift: DataFrame, thresholds: Thresholds = DEFAULTS) -> DataFrame:
    return drift.agg(F.max("psi").alias("max_feature_psi")).withColumn(
        "drift_status", drift_status("max_feature_psi", thresholds)
    )


def quality_measures(results: DataFrame, by: By = (), thresholds: Thresholds = DEFAULTS) -> DataFrame:
    return _grouped(
        results,
        by,
        F.avg("pass_rate").alias("dq_pass_rate"),
        count_true(~F.col("passed")).alias("dq_rules_failing"),
    ).withColumn("dq_status", pass_rate_status_strict("dq_pass_rate", thresholds))


def anomaly_measures(anomalies: DataFrame, by: By = ()) -> DataFrame:
    return _grouped(anomalies, by, F.count("*").alias("inventory_anomalies"))


def promotion_measures(uplift: DataFrame, by: By = ()) -> DataFrame:
    return _grouped(
        uplift,
        by,
        F.count("*").alias("promo_events"),
        F.avg("uplift_pct").alias("avg_uplift_pct"),
        F.avg("planned_uplift_pct").alias("avg_planned_uplift_pct"),
    ).withColumn("uplift_variance_pp", F.col("avg_uplift_pct") - F.col("avg_planned_uplift_pct"))


# --- periods ----------------------------------------------------------------------------------------------------


def with_periods(monthly: DataFrame, values: By, month: str = "month", by: By = ()) -> DataFrame:
    """Each value of a monthly aggregate beside its prior month and the same month of last year.

    Every month is also handed to the months it is compared with, one and twelve later, and meets them in one grouping:
    the aggregate is computed once, and a gap gives NULL instead of the next older month.
    """
    roles = {"": 0, "_prior": 1, "_last_year": 12}
    hops = F.array(*[F.struct(F.lit(n).alias("hop"), F.add_months(month, n).alias("at")) for n in roles.values()])
    rest = [c for c in monthly.columns if c not in (*by, month, *values)]
    met = monthly.select(*by, *values, *rest, F.inline(hops)).groupBy(*by, F.col("at").alias(month))
    own = F.col("hop") == 0
    return (
        met.agg(
            F.bool_or(own).alias("_exists"),
            *[F.max(F.when(own, F.col(c))).alias(c) for c in rest],
            *[
                F.max(F.when(F.col("hop") == n, F.col(v))).alias(f"{v}{suffix}")
                for suffix, n in roles.items()
                for v in values
            ],
        )
        .where("_exists")
        .drop("_exists")
    )


def month_over_month(monthly: DataFrame, value: str, month: str = "month", by: By = ()) -> DataFrame:
    """Relative change to the prior month."""
    both = with_periods(monthly, [value], month, by)
    change = safe_divide(F.col(value) - F.col(f"{value}_prior"), f"{value}_prior")
    return both.withColumn(f"{value}_mom_pct", change)


def year_over_year_delta(monthly: DataFrame, value: str, month: str = "month", by: By = ()) -> DataFrame:
    """Difference to the same month of last year."""
    both = with_periods(monthly, [value], month, by)
    return both.withColumn(f"{value}_yoy_delta", F.col(value) - F.col(f"{value}_last_year"))


# --- selection --------------------------------------------------------------------------------------------------


def kpi_table(wide: DataFrame, names: dict[str, str]) -> DataFrame:
    """A one-row KPI frame as ``kpi, value`` rows. ``names``: shown name to column."""
    lines = F.array(
        *[F.struct(F.lit(n).alias("kpi"), F.col(c).cast("double").alias("value")) for n, c in names.items()]
    )
    return wide.select(F.inline(lines))


def selected_kpi(kpis: DataFrame, selection: str | None, default: str = "Inventory Turns") -> DataFrame:
    """The chosen KPI; the default one when nothing known is chosen."""
    known = kpis.where(F.col("kpi") == (selection or default))
    if selection is None or selection == default:
        return known
    hit = kpis.agg(F.coalesce(F.bool_or(F.col("kpi") == selection), F.lit(False)).alias("x")).scalar()
    return kpis.where(F.col("kpi") == F.when(hit, F.lit(selection)).otherwise(F.lit(default)))


# --- row-level security -----------------------------------------------------------------------------------------

# Role to the dimension column it is restricted on, and the roles that see everything.
ROLE_COLUMNS = {"Regional Planner": "region", "Category Manager": "category"}
UNRESTRICTED_ROLES = ("Executive", "Data Steward")


def _role_column(role: str) -> str | None:
    """Column that restricts a role, none for a role without restriction; a role that isn't known is refused."""
    if role in UNRESTRICTED_ROLES:
        return None
    if role not in ROLE_COLUMNS:
        raise ValueError(f"unknown role {role!r}")
    return ROLE_COLUMNS[role]


def apply_role(df: DataFrame, role: str, allowed: Sequence[str]) -> DataFrame:
    """Rows of a dimension, or of a fact that carries the column, that a role may see.

    A role that isn't known, or whose column isn't there, is an error: nothing is shown by mistake.
    """
    column = _role_column(role)
    if column is None:
        return df
    if column not in df.columns:
        raise ValueError(f"role {role!r} is restricted on {column!r}, which is not among the columns")
    return df.where(F.col(column).isin(*allowed)) if allowed else df.where(F.lit(False))


def restrict_fact(fact: DataFrame, dimension: DataFrame, key: str, role: str, allowed: Sequence[str]) -> DataFrame:
    """Rows of a fact whose dimension row the role may see; the dimension must carry the role's column."""
    if _role_column(role) is None:
        return fact
    return fact.join(apply_role(dimension, role, allowed).select(key), key, "left_semi").select(*fact.columns)


def with_location(inventory: DataFrame, stores: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Region of each stock row, from the store or the warehouse dimension by location type."""
    places = stores.select(
        F.lit("Store").alias("location_type"), F.col("store_id").alias("location_id"), "region"
    ).unionByName(
        warehouses.select(
            F.lit("Warehouse").alias("location_type"), F.col("warehouse_id").alias("location_id"), "region"
        )
    )
    return inventory.join(places, ["location_type", "location_id"], "left")


def by_month(df: DataFrame, measure: Callable[..., DataFrame], date: str, *rest) -> DataFrame:
    """A measure grouped by calendar month of a date column."""
    month = F.to_date(F.date_trunc("month", F.col(date))).alias("month")
    return measure(df.select("*", month), *rest, by=["month"])
