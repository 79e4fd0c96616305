"""Forecast, drift, delivery and quality monitoring with retrain and fallback triggers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockloom.functions import accuracy
from stockloom.functions.banding import (
    DEFAULTS,
    Thresholds,
    drift_status,
    late_rate_status,
    pass_rate_status,
    wmape_status,
)
from stockloom.functions.columns import rounded, safe_divide
from stockloom.functions.quantiles import quantiles_from_counts, range_parts
from stockloom.sources.durable import durable

DRIFT_FEATURES = ["units_sold", "unit_price", "avg_temp_c"]


def weekly_forecast_performance(
    rows: DataFrame,
    actual: str = "units_sold",
    forecast: str = "forecast_units",
    by: tuple[str, ...] = (),
    thresholds: Thresholds = DEFAULTS,
) -> DataFrame:
    """WMAPE, number of rows and status per week, optionally split further."""
    w = accuracy.wmape(actual, forecast)
    return (
        rows.groupBy(*by, "week")
        .agg(w.alias("w"), F.count("*").alias("n_series"))
        .select(*by, "week", rounded("w", 4).alias("wmape"), "n_series", wmape_status("w", thresholds).alias("status"))
        .orderBy(*by, "week")
    )


# --- drift ------------------------------------------------------------------------------------------------------


def value_counts(rows: DataFrame, features: list[str], reference: Column, current: Column) -> DataFrame:
    """Rows per feature value in the reference and in the current period; a row may belong to both."""
    lines = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("v")) for f in features])
    return (
        rows.where(reference | current)
        .select(reference.alias("in_ref"), current.alias("in_cur"), F.inline(lines))
        .where(F.col("v").isNotNull())
        .groupBy("feature", "v")
        .agg(F.count_if("in_ref").alias("ref"), F.count_if("in_cur").alias("cur"))
    )


def psi_from_counts(counts: DataFrame, buckets: int = 10) -> DataFrame:
    """Population stability index per feature from value counts that went through ``range_parts``.

    The bucket edges are the distinct quantiles of the reference values; only values between the outer edges count, the
    last bucket is closed, and empty shares are raised to 1e-4. Fewer than 10 values on a side give NULL, fewer than 3
    edges give 0. Values were counted before, so a frequent value costs as much as a rare one.
    """
    quantiles = quantiles_from_counts(counts, "feature", "v", "ref", [i / buckets for i in range(buckets + 1)])
    current = counts.groupBy("feature").agg(F.sum("cur").alias("cur_rows"))
    # A feature without reference rows has no quantiles; its edges are NULL and its index too.
    edges = quantiles.join(current, "feature").select(
        "feature",
        F.col("rows").alias("ref_rows"),
        "cur_rows",
        F.array_sort(F.array_distinct("quantiles")).alias("edges"),
    )
    e, v = F.col("edges"), F.col("v")
    inside = (v >= F.get(e, F.lit(0))) & (v <= F.element_at(e, -1))
    position = F.least(F.size(F.filter(e, lambda x: x <= v)), F.size(e) - 1)
    filled = (
        counts.join(edges.select("feature", "edges"), "feature")
        .where(inside)
        .groupBy("feature", position.alias("bucket"))
        .agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))
    )
    every = edges.where(F.size("edges") >= 3).select(
        "feature", F.explode(F.sequence(F.lit(1), F.size("edges") - 1)).alias("bucket")
    )
    per_feature = Window.partitionBy("feature")

    def share(side: str) -> Column:
        n = F.coalesce(F.col(side), F.lit(0))
        whole = F.greatest(F.sum(n).over(per_feature), F.lit(1))
        return F.greatest(safe_divide(n, whole), F.lit(1e-4))

    gap = (F.col("c") - F.col("r")) * F.ln(F.col("c") / F.col("r"))
    summed = (
        every.join(filled, ["feature", "bucket"], "left")
        .select("feature", share("ref").alias("r"), share("cur").alias("c"))
        .groupBy("feature")
        .agg(F.sum(gap).alias("psi"))
    )
    enough = (F.col("ref_rows") >= 10) & (F.col("cur_rows") >= 10)
    return edges.join(summed, "feature", "left").select(
        "feature", F.when(enough, F.coalesce("psi", F.lit(0.0))).alias("psi")
    )


def psi(reference: DataFrame, current: DataFrame, column: str, buckets: int = 10) -> DataFrame:
    """Index of one column between two DataFrames: one row ``feature, psi``."""
    both = reference.select(column, F.lit(True).alias("is_ref")).unionByName(
        current.select(column, F.lit(False).alias("is_ref"))
    )
    counts = value_counts(both, [column], F.col("is_ref"), ~F.col("is_ref"))
    return psi_from_counts(durable(range_parts(counts, "feature", "v"), "value-counts"), buckets)


def demand_drift(
    panel: DataFrame,
    features: list[str] = DRIFT_FEATURES,
    reference_weeks: int = 12,
    thresholds: Thresholds = DEFAULTS,
) -> DataFrame:
    """Index of each feature between the first and the last weeks of the panel.

    Both periods shrink to a third of the history (4 weeks at least) when they would overlap.
    """
    n = F.size("weeks")
    third = F.greatest(F.lit(4), F.floor(n / 3).cast("int"))
    span = F.least(F.when(n < 2 * reference_weeks, third).otherwise(reference_weeks), n)
    bounds = (
        panel.agg(F.array_sort(F.collect_set("week")).alias("weeks"))
        .select(
            F.struct(
                F.element_at("weeks", span).alias("ref_end"), F.element_at("weeks", -span).alias("cur_start")
            ).alias("b")
        )
        .scalar()
    )
    reference = F.col("week") <= bounds.getField("ref_end")
    current = F.col("week") >= bounds.getField("cur_start")
    # The counts feed the edges and the buckets; written once, the panel behind them is read once.
    counts = durable(range_parts(value_counts(panel, features, reference, current), "feature", "v"), "drift-counts")
    index = psi_from_counts(counts)
    return index.select(
        "feature", rounded("psi", 4).alias("psi"), drift_status("psi", thresholds).alias("status")
    )


# --- summaries --------------------------------------------------------------------------------------------------


def supplier_delivery_status(lead_times: DataFrame, thresholds: Thresholds = DEFAULTS) -> DataFrame:
    late = 1 - F.col("on_time_rate")
    return lead_times.withColumn("late_rate", late).withColumn("status", late_rate_status("late_rate", thresholds))


def alert_bounds(t: Thresholds = DEFAULTS) -> Column:
    """The bounds of the status bands as one struct, under their published names (fixed)."""
    bounds = {
        "wmape_warning": t.wmape_warning,
        "wmape_critical": t.wmape_critical,
        "psi_warning": t.psi_warning,
        "psi_critical": t.psi_critical,
        "dq_pass_rate_warning": t.dq_warning,
        "dq_pass_rate_critical": t.dq_critical,
        "late_delivery_rate_warning": t.late_warning,
        "late_delivery_rate_critical": t.late_critical,
    }
    return F.struct(*[F.lit(float(v)).alias(n) for n, v in bounds.items()])


def monitoring_summary(
    performance: DataFrame,
    drift: DataFrame,
    quality: DataFrame,
    auc: Column | float | None,
    anomalies: DataFrame,
    thresholds: Thresholds = DEFAULTS,
) -> DataFrame:
    """One row with the newest forecast error, worst drift, quality band, model AUC, open anomalies and the alert bounds.

    Every input is reduced to a scalar of its own, so nothing is joined.
    """
    newest = performance.agg(F.max_by(F.struct("wmape", "status"), "week").alias("p")).scalar()
    # A feature without an index sorts last and never decides the status.
    worst = drift.agg(F.max_by(F.struct("psi", "status"), F.coalesce("psi", F.lit(-1.0))).alias("d")).scalar()
    dq = quality.agg(pass_rate_status(F.avg("pass_rate")).alias("s")).scalar()
    count = anomalies.agg(F.count("*").alias("n")).scalar()
    spark = performance.sparkSession
    return spark.range(1).select(
        newest.getField("wmape").alias("latest_weekly_wmape"),
        F.coalesce(newest.getField("status"), F.lit("Unknown")).alias("forecast_status"),
        worst.getField("psi").alias("max_feature_psi"),
        F.coalesce(worst.getField("status"), F.lit("Unknown")).alias("drift_status"),
        dq.alias("data_quality_status"),
        (auc if isinstance(auc, Column) else F.lit(auc)).cast("double").alias("lead_time_risk_model_auc"),
        count.alias("open_inventory_anomalies"),
        alert_bounds(thresholds).alias("thresholds"),
    )


# --- triggers ---------------------------------------------------------------------------------------------------


def retrain_weeks(performance: DataFrame, consecutive: int = 3, thresholds: Thresholds = DEFAULTS) -> DataFrame:
    """Weeks that close a run of ``consecutive`` weeks at or above the warning bound.

    The window orders the weekly summary, one row per week, not the panel.
    """
    order = Window.orderBy("week").rowsBetween(-(consecutive - 1), 0)
    breach = (F.col("wmape") >= thresholds.wmape_warning).cast("int")
    return performance.select(
        "week", "wmape", F.coalesce(F.sum(breach).over(order) >= consecutive, F.lit(False)).alias("retrain")
    )


def late_rate_shift(
    orders: DataFrame, split_date: Column, date: str = "order_date", bound: float = DEFAULTS.base_rate_shift
) -> DataFrame:
    """Late rate before and from a date, and whether the base rate moved by more than the bound."""
    late = F.when(F.col("is_late"), 1.0).otherwise(0.0)
    recent = F.col(date) >= split_date
    rates = orders.agg(F.avg(F.when(~recent, late)).alias("before"), F.avg(F.when(recent, late)).alias("after"))
    shift = F.abs(F.col("after") - F.col("before"))
    return rates.select(
        rounded("before", 4).alias("late_rate_before"),
        rounded("after", 4).alias("late_rate_after"),
        F.coalesce(shift > bound, F.lit(False)).alias("retrain"),
    )


def fall_back_by_category(comparison: DataFrame, thresholds: Thresholds = DEFAULTS) -> DataFrame:
    """Baseline forecast for categories whose champion error is critical, champion forecast for the others."""
    error = accuracy.wmape("units_sold", "forecast_units_advanced")
    status = comparison.groupBy("category").agg(wmape_status(error, thresholds).alias("category_status"))
    return comparison.join(status, "category").withColumn(
        "forecast_units",
        F.when(F.col("category_status") == "Critical", F.col("forecast_units_baseline")).otherwise(
            F.col("forecast_units_advanced")
        ),
    )


def stale_scenarios(log: DataFrame, today: Column, max_age_days: int = DEFAULTS.scenario_max_age_days) -> DataFrame:
    """Scenarios still in use although they were run more than ``max_age_days`` days ago. ``log``: scenario, run_date."""
    age = F.datediff(today, F.col("run_date"))
    return log.withColumn("age_days", age).where(F.col("age_days") > max_age_days)
