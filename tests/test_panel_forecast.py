import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import day, one, rows
from stockloom.operators import forecasting, panel, reconciliation

MONDAY = day("2026-01-05")


def sales(spark, series, weeks=30, seed=0):
    """Daily sales on Tuesday and Friday of each week."""
    rng = np.random.default_rng(seed)
    out = []
    for store, sku in series:
        for w in range(weeks):
            for offset in (1, 4):
                units = int(rng.poisson(40 + 10 * (sku == "B")))
                out.append((MONDAY + dt.timedelta(days=7 * w + offset), store, sku, units, units * 2.0, bool(w % 5 == 0)))
    return spark.createDataFrame(out, "date date, store_id string, sku_id string, units_sold bigint, revenue double, promo_flag boolean")


def dims(spark):
    skus = spark.createDataFrame([("A", "Snacks", 2.0), ("B", "Dairy", 3.0)], "sku_id string, category string, unit_price double")
    stores = spark.createDataFrame([("S1", "N", "Metro"), ("S2", "S", "Express")], "store_id string, region string, store_format string")
    return skus, stores


def covariates(spark):
    weather = spark.createDataFrame(
        [(MONDAY, "N", 10.0, 1.0), (MONDAY + dt.timedelta(days=2), "N", 20.0, None), (MONDAY, "S", 30.0, 5.0)],
        "date date, region string, avg_temp_c double, precipitation_mm double",
    )
    holidays = spark.createDataFrame([(MONDAY, "N"), (MONDAY + dt.timedelta(days=6), "N")], "date date, region string")
    return holidays, weather


@pytest.fixture(scope="module")
def built(spark):
    series = [("S1", "A"), ("S1", "B"), ("S2", "A"), ("S2", "B")]
    df = panel.weekly_demand_panel(sales(spark, series), *dims(spark), *covariates(spark)).cache()
    return df


def test_panel_equals_pandas(spark, built):
    got = built.toPandas().sort_values(["store_id", "sku_id", "week"]).reset_index(drop=True)
    assert len(got) == 4 * 30
    group = got.groupby(["store_id", "sku_id"])["units_sold"]
    for k in (1, 2, 4):
        pd.testing.assert_series_equal(got[f"lag_{k}"].astype(float), group.shift(k).astype(float), check_names=False)
    mean = group.transform(lambda s: s.shift(1).rolling(4, min_periods=1).mean())
    std = group.transform(lambda s: s.shift(1).rolling(4, min_periods=1).std()).fillna(0)
    np.testing.assert_allclose(got.rolling_mean_4.astype(float), mean, equal_nan=True)
    np.testing.assert_allclose(got.rolling_std_4, std, atol=1e-9)
    assert (got.week_sin - np.sin(2 * np.pi * got.week_of_year / 52)).abs().max() < 1e-12


def test_panel_fills_covariates(built):
    first = {r["store_id"]: r for r in rows(built.where(F.col("week") == F.lit(str(MONDAY)).cast("date")))}
    assert (first["S1"]["avg_temp_c"], first["S1"]["precipitation_mm"], first["S1"]["holiday_count"]) == (15.0, 1.0, 2)
    later = rows(built.where(F.col("week") > F.lit(str(MONDAY)).cast("date")))
    # median over panel rows that have weather: two rows each of 15 and 30 degrees
    assert {r["avg_temp_c"] for r in later} == {22.5} and {r["precipitation_mm"] for r in later} == {3.0}
    assert {r["holiday_count"] for r in later} == {0}


def test_panel_codes_are_alphabetical(built):
    codes = {(r["category"], r["category_enc"]) for r in rows(built)} | {(r["store_format"], r["store_format_enc"]) for r in rows(built)}
    assert codes == {("Dairy", 0), ("Snacks", 1), ("Express", 0), ("Metro", 1)}


def test_unknown_code_is_minus_one(spark):
    df = spark.range(1).select(panel.ordinal_code(F.lit("z"), F.array(F.lit("a"), F.lit("b"))).alias("c"))
    assert one(df)["c"] == -1


def test_partial_weeks_can_be_dropped(spark):
    df = spark.createDataFrame(
        [(MONDAY + dt.timedelta(days=d), "S1", "A", 1, 1.0, False) for d in range(2, 18)],
        "date date, store_id string, sku_id string, units_sold bigint, revenue double, promo_flag boolean",
    )
    full = panel.weekly_demand_panel(df, *dims(spark), *covariates(spark), drop_partial_weeks=True)
    assert [(str(r["week"]), r["units_sold"]) for r in rows(full)] == [(str(MONDAY + dt.timedelta(days=7)), 7)]


def test_split_is_ordered_in_time(built):
    train, test = panel.split_train_test(built, 4)
    assert one(train.agg(F.max("week").alias("m")))["m"] < one(test.agg(F.min("week").alias("m")))["m"]
    assert test.select("week").distinct().count() == 4
    assert train.where("lag_4 is null").count() == 0 and train.count() == 4 * (30 - 4 - 4)


def test_split_of_a_short_history_tests_everything(built):
    train, test = panel.split_train_test(built, 99)
    assert train.count() == 0 and test.count() == built.count()


def test_moving_average_falls_back(spark):
    df = spark.createDataFrame([(4.0, 1), (None, 7), (None, None)], "rolling_mean_4 double, lag_1 bigint")
    assert [r["forecast_units"] for r in rows(forecasting.forecast_moving_average(df))] == [4.0, 7.0, 0.0]


def test_series_mean_uses_training_only(spark):
    ddl = "store_id string, sku_id string, units_sold bigint"
    train = spark.createDataFrame([("S", "A", 2), ("S", "A", 4), ("S", "B", 9)], ddl)
    test = spark.createDataFrame([("S", "A", 100), ("T", "A", 100)], ddl)
    _, out = forecasting.add_series_mean(train, test)
    assert {r["store_id"]: r["combo_mean_hist"] for r in rows(out)} == {"S": 3.0, "T": 5.0}


def loop(y, alpha, beta, phi, horizon):
    """Plain recursion of the damped trend."""
    m = min(10, len(y))
    slope, start = np.polyfit(np.arange(1, m + 1), y[:m], 1)
    level, trend, sse = start, slope, 0.0
    for v in y:
        expected = level + phi * trend
        new = alpha * v + (1 - alpha) * expected
        trend = beta * (new - level) + (1 - beta) * phi * trend
        level = new
        sse += (v - expected) ** 2
    return sse, [max(level + trend * sum(phi**i for i in range(1, h + 1)), 0) for h in range(1, horizon + 1)]


def test_smoothing_equals_a_plain_loop(spark, built):
    grid = [(0.2, 0.1, 0.9), (0.6, 0.3, 0.8)]
    got = rows(forecasting.forecast_exponential_smoothing(built, 8, grid), "sku_id", "week")
    totals = built.groupBy("sku_id", "week").agg(F.sum("units_sold").alias("u")).toPandas().sort_values(["sku_id", "week"])
    assert len(got) == 16
    for sku, g in totals.groupby("sku_id"):
        y = np.maximum(g.u.to_numpy(dtype=float)[:-8], 0.1)
        _, expected = min((loop(y, *p, 8) for p in grid), key=lambda x: x[0])
        np.testing.assert_allclose([r["forecast_units"] for r in got if r["sku_id"] == sku], expected)
        assert [r["actual_units"] for r in got if r["sku_id"] == sku] == list(g.u[-8:])


def test_smoothing_skips_short_series(spark):
    df = spark.createDataFrame(
        [(s, MONDAY + dt.timedelta(days=7 * w), 5) for s, n in (("long", 16), ("short", 15)) for w in range(n)],
        "sku_id string, week date, units_sold bigint",
    )
    got = forecasting.forecast_exponential_smoothing(df)
    assert {r["sku_id"] for r in rows(got)} == {"long"}
    assert all(abs(r["forecast_units"] - 5) < 1e-9 for r in rows(got))


def test_boosted_trees_forecast_and_reconcile(spark, built):
    train, test = panel.split_train_test(built, 4)
    model, champion = forecasting.forecast_boosted_trees(train, test, rounds=5, step=0.3)
    champion = champion.cache()
    assert champion.count() == test.count()
    assert one(champion.agg(F.min("forecast_units").alias("m")))["m"] >= 0
    assert len(model.trees) == 5
    baseline = forecasting.forecast_moving_average(test)
    smoothing = forecasting.forecast_exponential_smoothing(built, 4)
    out = {(r["method"], r["level"]): r for r in rows(reconciliation.reconcile(champion, smoothing, baseline))}
    assert len(out) == 11
    gbm = "Bottom-up (GBM)"
    assert out[gbm, "Total"]["wmape"] <= out[gbm, "Store-SKU"]["wmape"]
    assert [out[gbm, level]["n_series"] for level in reconciliation.LEVELS] == [4, 2, 2, 1]
    improvement = one(forecasting.relative_improvement(forecasting.compare_forecasts(champion, baseline)))
    assert improvement["advanced_wmape"] == out[gbm, "Store-SKU"]["wmape"]


def test_every_pair_equals_the_plain_join(spark):
    actual = spark.createDataFrame(
        [("S1", "A", 1, 10, "X"), ("S2", "A", 1, 30, "X"), ("S1", "A", 2, 20, "X"), ("S1", "B", 1, 0, "Y"), ("S3", "B", 2, 0, "Y")],
        "store_id string, sku_id string, week int, units_sold bigint, category string",
    )
    forecast = spark.createDataFrame([("A", 1, 50.0), ("A", 2, 15.0), ("B", 1, 3.0)], "sku_id string, week int, forecast_units double")
    a, f = actual.toPandas(), forecast.toPandas()
    share = a.groupby(["sku_id", "store_id"]).units_sold.sum()
    share = (share / share.groupby("sku_id").transform("sum")).rename("share").reset_index()
    td = f.merge(share, on="sku_id")
    td["forecast_units"] *= td["share"].fillna(1 / a.store_id.nunique())
    td = td.merge(a, on=["sku_id", "week"])
    expected = td.groupby(["sku_id", "week"])[["units_sold", "forecast_units"]].sum().reset_index()
    got = reconciliation.top_down_rows_every_pair(forecast, actual).toPandas().sort_values(["sku_id", "week"])
    np.testing.assert_allclose(got[["units_sold", "forecast_units"]], expected[["units_sold", "forecast_units"]])
    split = rows(reconciliation.top_down_rows(forecast, actual), "sku_id", "week", "store_id")
    assert [r["forecast_units"] for r in split][:2] == [50 * 30 / 60, 50 * 30 / 60]


def test_latest_weeks(spark):
    df = spark.createDataFrame([(MONDAY + dt.timedelta(days=7 * w),) for w in range(20)], "week date")
    assert panel.latest_weeks(df).count() == 13
