"""Panel, three forecasts and their comparison."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from stockloom.operators import forecasting
from stockloom.operators.boosting import BoostedTrees
from stockloom.operators.panel import split_train_test, weekly_demand_panel
from stockloom.operators.reconciliation import reconcile
from stockloom.sources.durable import durable


@dataclass
class ForecastRun:
    panel: DataFrame
    baseline: DataFrame
    champion: DataFrame
    smoothing: DataFrame
    comparison: DataFrame
    improvement: DataFrame
    reconciliation: DataFrame
    model: BoostedTrees


def run_forecasts(
    tables: Mapping[str, DataFrame], test_weeks: int = 8, every_pair: bool = True, **model_settings
) -> ForecastRun:
    """The panel and the champion forecast are written once, because several later steps read each of them."""
    panel = durable(
        weekly_demand_panel(
            tables["daily_sales"], tables["skus"], tables["stores"], tables["holidays"], tables["weather"]
        ),
        "panel",
    )
    train, test = split_train_test(panel, test_weeks)
    baseline = forecasting.forecast_moving_average(test)
    model, champion = forecasting.forecast_boosted_trees(train, test, **model_settings)
    champion = durable(champion, "champion")
    smoothing = durable(forecasting.forecast_exponential_smoothing(panel, test_weeks), "smoothing")
    comparison = forecasting.compare_forecasts(champion, baseline)
    return ForecastRun(
        panel=panel,
        baseline=baseline,
        champion=champion,
        smoothing=smoothing,
        comparison=comparison,
        improvement=forecasting.relative_improvement(comparison),
        reconciliation=reconcile(champion, smoothing, baseline, every_pair),
        model=model,
    )
