"""Stock-policy formulas as column expressions."""

from __future__ import annotations

from statistics import NormalDist

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from stockloom.functions.columns import col, rounded, safe_divide
from stockloom.shipping import ship_with_tasks


@F.pandas_udf(DoubleType())
def normal_quantile(p: pd.Series) -> pd.Series:
    """Standard normal quantile; null outside the open interval from 0 to 1."""
    quantile = NormalDist().inv_cdf
    return p.map(lambda x: quantile(x) if 0 < x < 1 else None).astype("float64")


def category_z(levels: DataFrame) -> DataFrame:
    """``category, z`` (2 decimals) of a table of target service levels by category."""
    return levels.select("category", rounded(normal_quantile("target_service_level"), 2).alias("z"))


def safety_stock(demand_mean, demand_std, lead_days, lead_std, z) -> Column:
    """z times the standard deviation of demand over a variable lead time."""
    mean, std, days, spread = (col(c) for c in (demand_mean, demand_std, lead_days, lead_std))
    variance = days * std * std + mean * mean * spread * spread
    return col(z) * F.sqrt(F.greatest(variance, F.lit(0.0)))


def reorder_point(demand_mean, lead_days, stock) -> Column:
    return col(demand_mean) * col(lead_days) + col(stock)


def economic_order_quantity(annual_demand, order_cost, holding_cost) -> Column:
    """Square-root order size; 0 when there is no demand or no holding cost."""
    demand, holding = col(annual_demand), col(holding_cost)
    return F.when(
        (demand > 0) & (holding > 0), F.sqrt(safe_divide(F.lit(2.0) * demand * col(order_cost), holding))
    ).otherwise(0.0)


def inventory_turns(cogs_annual, inventory_value) -> Column:
    value = col(inventory_value)
    return F.when(value > 0, safe_divide(cogs_annual, value))


def days_of_supply(on_hand, mean_daily_demand, floor: float = 0.1) -> Column:
    return col(on_hand) / F.greatest(col(mean_daily_demand), F.lit(floor))


ship_with_tasks(__name__)
