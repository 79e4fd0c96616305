"""Promotion uplift against the same weekdays of the three weeks before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.functions.banding import DEFAULTS
from stockloom.functions.columns import rounded, safe_divide

BASELINE_DAYS = 21
EVENT = ["promo_id", "sku_id", "promo_type", "start_date", "end_date", "planned_uplift_pct"]


def promotion_days(promotions: DataFrame, lead_in: int = 0) -> DataFrame:
    """One row per promotion and day, from ``lead_in`` days before the start to the end.

    Turning the interval into days makes every later join a plain equality on SKU and date: a busy SKU spreads over its
    dates and there is no range condition left to evaluate on candidate pairs.
    """
    return promotions.where(F.col("end_date") >= F.col("start_date")).select(
        *promotions.columns, F.explode(F.sequence(F.date_sub("start_date", lead_in), F.col("end_date"))).alias("date")
    )


def sku_days(sales: DataFrame) -> DataFrame:
    """Sales rows of a SKU and day over all stores: units, rows and rows with a value."""
    return sales.groupBy("sku_id", "date").agg(
        F.sum("units_sold").alias("units"), F.count("*").alias("rows"), F.count("units_sold").alias("filled")
    )


def promotion_uplift(sales: DataFrame, promotions: DataFrame, skus: DataFrame) -> DataFrame:
    """Actual and expected units per promotion event.

    A sale during the promotion is expected to reach the mean of its weekday in the baseline window, or the mean of the
    whole window for a weekday without sales. Only sums and counts are needed for that, so sales are reduced to SKU and
    day before they meet the promotions. Events without sales in one of the two windows are left out.
    """
    days = promotion_days(promotions.select(*EVENT), BASELINE_DAYS)
    running = F.col("date") >= F.col("start_date")

    def total(column: str, during: Column) -> Column:
        return F.coalesce(F.sum(F.when(during, F.col(column))), F.lit(0))

    by_weekday = (
        days.join(sku_days(sales), ["sku_id", "date"])
        .groupBy(*EVENT, F.weekday("date").alias("weekday"))
        .agg(
            total("units", running).alias("units"),
            total("rows", running).alias("rows"),
            total("units", ~running).alias("base_units"),
            total("rows", ~running).alias("base_rows"),
            total("filled", ~running).alias("base_filled"),
        )
    )
    covered = F.col("base_filled") > 0
    events = (
        by_weekday.groupBy(*EVENT)
        .agg(
            F.sum("units").alias("actual"),
            F.sum("rows").alias("rows"),
            F.sum("base_rows").alias("base_rows"),
            safe_divide(F.sum("base_units"), F.sum("base_filled")).alias("base_mean"),
            F.coalesce(
                F.sum(F.when(covered, F.col("rows") * safe_divide("base_units", "base_filled"))), F.lit(0.0)
            ).alias("matched"),
            F.coalesce(F.sum(F.when(~covered, F.col("rows"))), F.lit(0)).alias("unmatched"),
        )
        .where((F.col("rows") > 0) & (F.col("base_rows") > 0))
        .withColumn("expected", F.col("matched") + F.col("unmatched") * F.col("base_mean"))
        .withColumn("uplift", F.col("actual") - F.col("expected"))
    )
    percent = F.when(F.col("expected") > 0, safe_divide("uplift", "expected") * 100)
    return events.join(skus.select("sku_id", "category"), "sku_id", "left").select(
        "promo_id",
        "sku_id",
        "promo_type",
        "start_date",
        "end_date",
        (F.datediff("end_date", "start_date") + 1).alias("duration_days"),
        F.col("actual").cast("bigint").alias("actual_units"),
        rounded("expected", 1).alias("expected_units_baseline"),
        rounded("uplift", 1).alias("uplift_units"),
        rounded(percent, 1).alias("uplift_pct"),
        "planned_uplift_pct",
        "category",
    )


def uplift_summary(detail: DataFrame, by: str = "promo_type") -> DataFrame:
    """Events, mean actual and planned uplift and their difference in points."""
    actual, planned = F.avg("uplift_pct"), F.avg("planned_uplift_pct")
    return detail.groupBy(by).agg(
        F.count("promo_id").alias("events"),
        rounded(actual, 1).alias("avg_uplift_pct"),
        rounded(planned, 1).alias("avg_planned_uplift_pct"),
        rounded(actual - planned, 1).alias("variance_pp"),
    )


def flag_promoted_sales(sales: DataFrame, promotions: DataFrame) -> DataFrame:
    """Sales with ``on_promotion``: some promotion of the SKU was running that day."""
    active = (
        promotion_days(promotions.select("sku_id", "start_date", "end_date"))
        .select("sku_id", "date")
        .distinct()
        .withColumn("on_promotion", F.lit(True))
    )
    return sales.join(active, ["sku_id", "date"], "left").withColumn(
        "on_promotion", F.coalesce("on_promotion", F.lit(False))
    )


def uplift_review_queue(detail: DataFrame, limit_pp: float = DEFAULTS.review_variance_pp) -> DataFrame:
    """Events whose uplift missed the plan by more than ``limit_pp`` points."""
    gap = F.col("uplift_pct") - F.col("planned_uplift_pct")
    return detail.withColumn("variance_pp", gap).where(F.abs(gap) > limit_pp)
