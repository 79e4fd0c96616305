"""Forecast accuracy up the hierarchy: bottom-up, top-down and baseline."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockloom.functions import accuracy
from stockloom.functions.columns import safe_divide

# Level name and the columns that identify a series on it.
LEVELS = {
    "Store-SKU": ["store_id", "sku_id"],
    "SKU": ["sku_id"],
    "Category": ["category"],
    "Total": [],
}


def accuracy_by_level(
    rows: DataFrame, method: str, levels=tuple(LEVELS), actual: str = "units_sold", forecast: str = "forecast_units"
) -> DataFrame:
    """Accuracy and number of series on each level.

    One grouping-sets aggregation rolls the rows up to every level by week; error sums are then added per series and
    per level, which also counts the series without a distinct.
    """
    keys = sorted({c for level in levels for c in LEVELS[level]})
    sets = [[*LEVELS[level], "week"] for level in levels]
    weekly = rows.groupingSets(sets, *keys, "week").agg(
        F.sum(actual).alias("a"),
        F.sum(forecast).alias("f"),
        *[F.grouping(k).alias(f"g_{k}") for k in keys],
    )
    label = F.lit(None).cast("string")
    for level in levels:
        present = F.lit(True)
        for k in keys:
            present = present & (F.col(f"g_{k}") == (0 if k in LEVELS[level] else 1))
        label = F.when(present, F.lit(level)).otherwise(label)
    series = (
        weekly.withColumn("level", label).groupBy("level", *keys).agg(*accuracy.error_sums("a", "f"))
    )
    return (
        series.groupBy("level")
        .agg(*accuracy.add_up_error_sums(), F.count("*").alias("n_series"))
        .select("level", F.lit(method).alias("method"), *accuracy.from_error_sums(), "n_series")
    )


def store_shares(rows: DataFrame, value: str = "units_sold") -> DataFrame:
    """Share of each store in the volume of a SKU; equal shares are used where there is no volume.

    The window runs over one row per store and SKU, so its partitions are bounded by the number of stores.
    """
    volume = rows.groupBy("sku_id", "store_id").agg(F.sum(value).alias("volume"))
    whole = Window.partitionBy("sku_id")
    n_stores = rows.agg(F.countDistinct("store_id").alias("n")).scalar()
    share = safe_divide("volume", F.sum("volume").over(whole))
    return volume.select(
        "sku_id", "store_id", F.coalesce(share, safe_divide(F.lit(1.0), n_stores)).alias("share")
    )


def top_down_rows(
    sku_forecast: DataFrame, rows: DataFrame, share_rows: DataFrame | None = None
) -> DataFrame:
    """SKU forecasts split over the stores that sold the SKU that week."""
    shares = store_shares(rows if share_rows is None else share_rows)
    actuals = rows.select("store_id", "sku_id", "week", "units_sold", "category")
    return (
        actuals.join(shares, ["sku_id", "store_id"])
        .join(sku_forecast.select("sku_id", "week", F.col("forecast_units").alias("sku_units")), ["sku_id", "week"])
        .withColumn("forecast_units", F.col("sku_units") * F.col("share"))
        .drop("sku_units", "share")
    )


def top_down_rows_every_pair(sku_forecast: DataFrame, rows: DataFrame) -> DataFrame:
    """Sums that a join of shares and actuals on SKU and week alone would give.

    That join repeats every actual once per store of the SKU and every share once per store that sold it. The pairs are
    never built: the repeats are the two counts that multiply the sums.
    """
    shares = store_shares(rows).groupBy("sku_id").agg(
        F.count("*").alias("stores"), F.sum("share").alias("share_sum")
    )
    weekly = rows.groupBy("sku_id", "week", "category").agg(
        F.sum("units_sold").alias("units"), F.count("*").alias("n")
    )
    return (
        weekly.join(shares, "sku_id")
        .join(sku_forecast.select("sku_id", "week", F.col("forecast_units").alias("sku_units")), ["sku_id", "week"])
        .select(
            "sku_id",
            "week",
            "category",
            (F.col("units") * F.col("stores")).alias("units_sold"),
            (F.col("sku_units") * F.col("share_sum") * F.col("n")).alias("forecast_units"),
        )
    )


def reconcile_top_down(
    sku_forecast: DataFrame,
    rows: DataFrame,
    share_rows: DataFrame | None = None,
    every_pair: bool = False,
    method: str = "Top-down (ETS share)",
) -> DataFrame:
    """Accuracy of the split SKU forecast on SKU, category and total level.

    ``every_pair`` weights SKUs by their number of stores, as a join without the store key does. ``share_rows`` takes
    the shares from other rows than the evaluated ones, for instance the training period.
    """
    split = (
        top_down_rows_every_pair(sku_forecast, rows)
        if every_pair
        else top_down_rows(sku_forecast, rows, share_rows)
    )
    return accuracy_by_level(split, method, ("SKU", "Category", "Total"))


def reconcile(
    champion: DataFrame, sku_forecast: DataFrame, baseline: DataFrame | None = None, every_pair: bool = True
) -> DataFrame:
    """All methods on all levels: 4 bottom-up rows, 3 top-down rows and 4 baseline rows."""
    parts = [
        accuracy_by_level(champion, "Bottom-up (GBM)"),
        reconcile_top_down(sku_forecast, champion, every_pair=every_pair),
    ]
    if baseline is not None:
        parts.append(accuracy_by_level(baseline, "Baseline (4-week moving average)"))
    return reduce(DataFrame.unionByName, parts)
