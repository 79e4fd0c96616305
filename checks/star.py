"""Retail tables of a test folder in all layers, built on demand."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockloom.functions.columns import rounded
from stockloom.operators import forecasting, gold, inventory, panel, promotions, quality, silver
from stockloom.sources.retail_tables import RetailTables
from stockloom.sources.durable import durable
from stockloom.sources.schemas import RAW_SCHEMAS


def tidy(df: DataFrame) -> DataFrame:
    """Doubles on four decimals, so results of two engines can be compared by value."""
    return df.select(
        *[rounded(f.name, 4).alias(f.name) if isinstance(f.dataType, T.DoubleType) else f.name for f in df.schema]
    )


class Star:
    """One instance per query; each table is described at most once and nothing runs before the result is used."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.tables = RetailTables(spark, folder)
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = getattr(self.tables, name)()
        return self._raw[name]

    def store(self, *names: str) -> None:
        """Write raw tables the query reads more than once."""
        for n in names:
            self._raw[n] = durable(self.raw(n), n.replace("_", "-"))

    def all_raw(self) -> dict[str, DataFrame]:
        return {n: self.raw(n) for n in RAW_SCHEMAS}

    # silver
    @cached_property
    def skus(self) -> DataFrame:
        return silver.drop_orphans(self.raw("skus"), self.raw("products"), "product_id")

    @cached_property
    def sales(self) -> DataFrame:
        return silver.clean_sales(self.raw("daily_sales"), self.skus)

    @cached_property
    def snapshots(self) -> DataFrame:
        return silver.clean_inventory(self.raw("inventory_snapshots"))

    @cached_property
    def orders(self) -> DataFrame:
        return silver.drop_orphans(self.raw("purchase_orders"), self.skus, "sku_id")

    @cached_property
    def weather(self) -> DataFrame:
        return silver.impute_by_group_mean(self.raw("weather"), "region", ["avg_temp_c", "precipitation_mm"])

    # gold
    @cached_property
    def dim_date(self) -> DataFrame:
        return gold.dim_date(self.sales)

    @cached_property
    def dim_product(self) -> DataFrame:
        return gold.dim_product(self.skus, silver.clean_products(self.raw("products")))

    @cached_property
    def dim_store(self) -> DataFrame:
        return gold.dim_store(silver.drop_orphans(self.raw("stores"), self.raw("warehouses"), "warehouse_id"))

    @cached_property
    def fact_sales(self) -> DataFrame:
        return gold.fact_daily_sales(self.sales)

    @cached_property
    def fact_inventory(self) -> DataFrame:
        return gold.fact_inventory(self.snapshots)

    @cached_property
    def fact_orders(self) -> DataFrame:
        return gold.fact_purchase_orders(self.orders)

    @cached_property
    def fact_stockouts(self) -> DataFrame:
        return gold.fact_stockouts(self.raw("stock_outs"))

    @cached_property
    def fact_decisions(self) -> DataFrame:
        return gold.fact_replenishment_decisions(self.raw("replenishment_decisions"))

    @cached_property
    def performance(self) -> DataFrame:
        return gold.supplier_performance(self.fact_orders, self.raw("suppliers"))

    # derived; the models read the raw tables
    @cached_property
    def panel(self) -> DataFrame:
        return panel.weekly_demand_panel(
            self.raw("daily_sales"), self.raw("skus"), self.raw("stores"), self.raw("holidays"), self.raw("weather")
        )

    @cached_property
    def saved_panel(self) -> DataFrame:
        """The panel as a written table, for queries that read it more than once."""
        return durable(self.panel, "panel")

    @cached_property
    def split(self) -> tuple[DataFrame, DataFrame]:
        return panel.split_train_test(self.saved_panel)

    @cached_property
    def baseline(self) -> DataFrame:
        return forecasting.forecast_moving_average(self.split[1])

    @cached_property
    def last_week_forecast(self) -> DataFrame:
        """A second, simple forecast to compare the baseline with."""
        return self.split[1].withColumn("forecast_units", F.coalesce(F.col("lag_1").cast("double"), F.lit(0.0)))

    @cached_property
    def comparison(self) -> DataFrame:
        return forecasting.compare_forecasts(self.baseline, self.last_week_forecast)

    @cached_property
    def sku_mean_forecast(self) -> DataFrame:
        """A SKU-level forecast plain SQL can state: the sum of the baseline forecasts of its stores."""
        return self.baseline.groupBy("sku_id", "week").agg(F.sum("forecast_units").alias("forecast_units"))

    @cached_property
    def demand_stats(self) -> DataFrame:
        """Read twice by the recommendations, and itself reads the sales twice."""
        self.store("daily_sales")
        return durable(inventory.demand_statistics(self.raw("daily_sales")), "demand-statistics")

    @cached_property
    def recommendations(self) -> DataFrame:
        self.store("lead_times")
        return inventory.reorder_recommendations(self.demand_stats, self.raw("lead_times"), self.raw("skus"))

    @cached_property
    def uplift(self) -> DataFrame:
        return promotions.promotion_uplift(self.raw("daily_sales"), self.raw("promotions"), self.raw("skus"))

    @cached_property
    def rules(self) -> DataFrame:
        needed = {r["table"] for r in quality.RULES} | {r["reference"]["table"] for r in quality.RULES if "reference" in r}
        return quality.run_quality_rules(self.spark, {n: self.raw(n) for n in needed})
