"""Weekly demand panel and the time split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockloom.functions.columns import col, week_start, yearly_phase
from stockloom.operators.recent import newest_month, since
from stockloom.sources.durable import durable

SERIES = ["store_id", "sku_id"]


def weekly_sales(sales: DataFrame, date: str = "date") -> DataFrame:
    """Units, revenue and promotion flag per series and Monday week, combined on the map side."""
    return sales.groupBy(*SERIES, week_start(date).alias("week")).agg(
        F.sum("units_sold").alias("units_sold"),
        F.sum("revenue").alias("revenue"),
        F.bool_or("promo_flag").alias("promo_flag"),
    )


def weekly_weather(weather: DataFrame) -> DataFrame:
    return weather.groupBy("region", week_start("date").alias("week")).agg(
        F.avg("avg_temp_c").alias("avg_temp_c"), F.avg("precipitation_mm").alias("precipitation_mm")
    )


def weekly_holidays(holidays: DataFrame) -> DataFrame:
    return holidays.groupBy("region", week_start("date").alias("week")).agg(F.count("*").alias("holiday_count"))


def ordinal_code(value: Column | str, sorted_values: Column) -> Column:
    """Position of a value in the sorted list of known values, -1 for an unknown one."""
    return F.array_position(sorted_values, col(value)).cast("int") - 1


def add_history(panel: DataFrame, value: str = "units_sold") -> DataFrame:
    """Positional lags and trailing statistics of the four rows before the current one.

    All of them share one partitioning and one sort. A series has one row per week, so no partition can outgrow the
    number of weeks of history.
    """
    order = Window.partitionBy(*SERIES).orderBy("week")
    before = order.rowsBetween(-4, -1)
    return (
        panel.withColumn("lag_1", F.lag(value, 1).over(order))
        .withColumn("lag_2", F.lag(value, 2).over(order))
        .withColumn("lag_4", F.lag(value, 4).over(order))
        .withColumn("rolling_mean_4", F.avg(value).over(before))
        .withColumn("rolling_std_4", F.coalesce(F.stddev_samp(value).over(before), F.lit(0.0)))
    )


def weekly_demand_panel(
    sales: DataFrame,
    skus: DataFrame,
    stores: DataFrame,
    holidays: DataFrame,
    weather: DataFrame,
    drop_partial_weeks: bool = False,
    date: str = "date",
) -> DataFrame:
    """Model-ready weekly panel per store and SKU.

    Sales are brought to week grain before any join, so the attribute and weather joins see weekly rows only. The
    weekly sums are written once: the panel and the global fill-in values both read them, and the sales, by far the
    largest input, are scanned a single time.
    """
    base = durable(weekly_sales(sales, date), "weekly-sales")
    if drop_partial_weeks:
        span = sales.agg(F.struct(F.min(date).alias("first"), F.max(date).alias("last")).alias("s")).scalar()
        base = base.where(
            (F.col("week") >= span.getField("first")) & (F.date_add("week", 6) <= span.getField("last"))
        )
    located = (
        base.join(skus.select("sku_id", "category", "unit_price"), "sku_id")
        .join(stores.select("store_id", "region", "store_format"), "store_id")
        .join(weekly_weather(weather), ["region", "week"], "left")
        .join(weekly_holidays(holidays), ["region", "week"], "left")
    )
    # Rows that share region, week, format and category share every input of the global aggregate.
    globals_ = (
        located.groupBy("region", "week", "store_format", "category", "avg_temp_c", "precipitation_mm")
        .agg(F.count("*").alias("n"))
        .agg(
            F.struct(
                F.percentile("avg_temp_c", F.lit(0.5), F.col("n")).alias("temp"),
                F.percentile("precipitation_mm", F.lit(0.5), F.col("n")).alias("rain"),
                F.array_sort(F.collect_set("store_format")).alias("formats"),
                F.array_sort(F.collect_set("category")).alias("categories"),
            ).alias("g")
        )
        .scalar()
    )
    woy = F.weekofyear("week")
    known = F.col("known")
    featured = located.withColumn("known", globals_).select(
        *SERIES,
        "category",
        "region",
        "store_format",
        "week",
        "units_sold",
        "revenue",
        "promo_flag",
        "unit_price",
        F.coalesce("avg_temp_c", known["temp"]).alias("avg_temp_c"),
        F.coalesce("precipitation_mm", known["rain"]).alias("precipitation_mm"),
        F.coalesce("holiday_count", F.lit(0)).alias("holiday_count"),
        woy.alias("week_of_year"),
        F.month("week").alias("month"),
        yearly_phase(woy, F.sin).alias("week_sin"),
        yearly_phase(woy, F.cos).alias("week_cos"),
        ordinal_code("store_format", known["formats"]).alias("store_format_enc"),
        ordinal_code("category", known["categories"]).alias("category_enc"),
    )
    return add_history(featured)


def split_train_test(panel: DataFrame, test_weeks: int = 8) -> tuple[DataFrame, DataFrame]:
    """The last ``test_weeks`` weeks are held out; training rows also need a full lag history."""
    # The distinct weeks are one short array; a history shorter than the test period is tested as a whole.
    weeks = panel.agg(F.array_sort(F.collect_set("week")).alias("weeks")).where(F.size("weeks") > 0)
    cutoff = weeks.select(
        F.element_at("weeks", -F.least(F.lit(test_weeks), F.size("weeks"))).alias("cutoff")
    ).scalar()
    train = panel.where(F.col("week") < cutoff).where(F.col("lag_4").isNotNull())
    return train, panel.where(F.col("week") >= cutoff)


def first_of_latest_weeks(df: DataFrame, weeks: int = 13, date: str = "week") -> Column:
    """Monday that opens the newest ``weeks`` calendar weeks of a date column, as a scalar subquery."""
    return newest_month(df).agg(F.date_sub(week_start(F.max(date)), 7 * (weeks - 1)).alias("d")).scalar()


def latest_weeks(df: DataFrame, weeks: int = 13, date: str = "week") -> DataFrame:
    """Rows of the newest ``weeks`` calendar weeks, the default period of the reports.

    Apply it to a fact before aggregating: the date filter then reaches the scan.
    """
    return since(df, date, first_of_latest_weeks(df, weeks, date))
