"""Moving-average, damped-trend and boosted-tree forecasts on the weekly panel."""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.functions import accuracy
from stockloom.functions.columns import rounded, safe_divide
from stockloom.operators.boosting import BoostedTrees, fit_boosted_trees
from stockloom.operators.panel import SERIES
from stockloom.shipping import ship_with_tasks

ship_with_tasks(__name__)

# Model inputs, in order.
FEATURES = [
    "lag_1",
    "lag_2",
    "lag_4",
    "rolling_mean_4",
    "rolling_std_4",
    "promo_flag",
    "holiday_count",
    "avg_temp_c",
    "precipitation_mm",
    "week_of_year",
    "month",
    "week_sin",
    "week_cos",
    "unit_price",
    "store_format_enc",
    "category_enc",
    "combo_mean_hist",
]

# Smoothing grid: level, trend and damping factors.
ETS_GRID = list(
    product(
        [0.05, 0.15, 0.25, 0.35, 0.45, 0.55, 0.65, 0.75, 0.85, 0.95],
        [0.01, 0.05, 0.1, 0.2, 0.4],
        [0.8, 0.85, 0.9, 0.95, 0.98],
    )
)


def forecast_moving_average(test: DataFrame) -> DataFrame:
    """Mean of the previous four weeks, else the last week, else zero."""
    return test.withColumn("forecast_units", F.coalesce("rolling_mean_4", "lag_1", F.lit(0.0)))


def add_series_mean(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Training-period mean of each series on both splits; a series unknown to training gets the overall mean."""
    means = train.groupBy(*SERIES).agg(F.avg("units_sold").alias("series_mean"))
    overall = train.agg(F.avg("units_sold").alias("m")).scalar()

    def attach(df: DataFrame) -> DataFrame:
        return (
            df.join(means, SERIES, "left")
            .withColumn("combo_mean_hist", F.coalesce("series_mean", overall))
            .drop("series_mean")
        )

    return attach(train), attach(test)


# --- damped exponential smoothing --------------------------------------------------------------------------------


def sku_weekly_totals(panel: DataFrame) -> DataFrame:
    return panel.groupBy("sku_id", "week").agg(F.sum("units_sold").alias("actual_units"))


def _smooth(y: np.ndarray, grid: np.ndarray) -> tuple[float, float, float]:
    """Last level, last trend and damping factor of the best grid point for one series.

    All grid points advance together, one vector step per observation. Level and trend start on the least-squares line
    through the first ten points.
    """
    head = y[:10]
    position = np.arange(1, len(head) + 1) - (len(head) + 1) / 2
    slope = float(position @ head) / float(position @ position)
    alpha, beta, phi = grid.T
    level = np.full(len(grid), head.mean() - slope * (len(head) + 1) / 2)
    trend = np.full(len(grid), slope)
    error = np.zeros(len(grid))
    for value in y:
        expected = level + phi * trend
        smoothed = alpha * value + (1 - alpha) * expected
        trend = beta * (smoothed - level) + (1 - beta) * phi * trend
        level = smoothed
        error += (value - expected) ** 2
    best = int(np.argmin(error))
    return float(level[best]), float(trend[best]), float(phi[best])


def forecast_exponential_smoothing(panel: DataFrame, test_weeks: int = 8, grid=None) -> DataFrame:
    """Damped-trend smoothing of each SKU total, fitted on all but the last ``test_weeks`` points.

    The parameters with the smallest one-step error on the grid win. A SKU is one row with its weekly totals as an
    array, as long as the history has weeks. The recursion over it is the one step done in Python: an Arrow batch of
    series with all grid points in one vector is far cheaper than folding each grid point with interpreted array
    functions. SKUs with fewer than ``test_weeks + 8`` points are left out.
    """
    points_of_grid = np.array(ETS_GRID if grid is None else grid, dtype=float)

    @F.pandas_udf("l double, b double, phi double")
    def fit(series: pd.Series) -> pd.DataFrame:
        rows = [_smooth(np.asarray(y, dtype=float), points_of_grid) for y in series]
        return pd.DataFrame(rows, columns=["l", "b", "phi"])

    # A fixed partition count keeps this compute-heavy stage spread out although its bytes are few.
    partitions = int(panel.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    points = F.col("points")
    training = F.slice(points, F.lit(1), F.size(points) - test_weeks)
    fitted = (
        sku_weekly_totals(panel)
        .repartition(partitions, "sku_id")
        .groupBy("sku_id")
        .agg(F.array_sort(F.collect_list(F.struct("week", "actual_units"))).alias("points"))
        .where(F.size("points") >= test_weeks + 8)
        .select(
            "sku_id",
            F.slice(points, -test_weeks, test_weeks).alias("held_out"),
            fit(F.transform(training, lambda p: F.greatest(p["actual_units"].cast("double"), F.lit(0.1)))).alias("fit"),
        )
    )
    ahead = fitted.select("sku_id", "fit", F.posexplode("held_out").alias("h", "point"))
    damping = F.aggregate(F.sequence(F.lit(1), F.col("h") + 1), F.lit(0.0), lambda a, i: a + F.pow(F.col("fit.phi"), i))
    return ahead.select(
        "sku_id",
        F.col("point.week").alias("week"),
        F.col("point.actual_units").alias("actual_units"),
        F.greatest(F.col("fit.l") + F.col("fit.b") * damping, F.lit(0.0)).alias("forecast_units"),
    )


# --- boosted trees ----------------------------------------------------------------------------------------------


def train_demand_model(train: DataFrame, **settings) -> BoostedTrees:
    """Boosted regression trees on the panel features, by default 300 trees of 27 leaves with at least 15 rows each.

    ``train`` comes from :func:`add_series_mean`; missing features count as 0, negative demand as none.
    """
    frame = train.withColumn("units_sold", F.greatest(F.col("units_sold").cast("double"), F.lit(0.0)))
    return fit_boosted_trees(frame, FEATURES, "units_sold", **settings)


def forecast_with_model(model: BoostedTrees, test: DataFrame) -> DataFrame:
    scored = model.score(test, "forecast_units")
    return scored.withColumn("forecast_units", F.greatest(F.col("forecast_units"), F.lit(0.0)))


def forecast_boosted_trees(train: DataFrame, test: DataFrame, **settings) -> tuple[BoostedTrees, DataFrame]:
    train, test = add_series_mean(train, test)
    model = train_demand_model(train, **settings)
    return model, forecast_with_model(model, test)


# --- comparison -------------------------------------------------------------------------------------------------


def forecast_accuracy(df: DataFrame, actual: str = "units_sold", forecast: str = "forecast_units", by=()) -> DataFrame:
    return df.groupBy(*by).agg(*accuracy.error_sums(actual, forecast)).select(*by, *accuracy.from_error_sums())


def compare_forecasts(champion: DataFrame, baseline: DataFrame) -> DataFrame:
    """Champion rows with the baseline forecast of the same series and week beside them."""
    other = baseline.select(*SERIES, "week", F.col("forecast_units").alias("forecast_units_baseline"))
    return champion.withColumnRenamed("forecast_units", "forecast_units_advanced").join(other, [*SERIES, "week"])


def relative_improvement(comparison: DataFrame) -> DataFrame:
    """WMAPE of both forecasts (4 decimals) and the relative improvement of the champion in per cent."""
    both = comparison.agg(
        rounded(accuracy.wmape("units_sold", "forecast_units_baseline"), 4).alias("baseline_wmape"),
        rounded(accuracy.wmape("units_sold", "forecast_units_advanced"), 4).alias("advanced_wmape"),
    )
    gain = safe_divide(F.col("baseline_wmape") - F.col("advanced_wmape"), "baseline_wmape") * 100
    return both.withColumn("relative_improvement_pct", rounded(gain, 2))
