import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import one, rows
from stockloom.functions import accuracy, banding, columns, stocking
from stockloom.functions.quantiles import exact_quantile, quantiles_from_counts, range_parts
from stockloom.sources.durable import durable


def value(spark, column):
    return one(spark.range(1).select(column.alias("v")))["v"]


def test_safe_divide_is_null_on_zero_and_null(spark):
    assert value(spark, columns.safe_divide(F.lit(1), F.lit(0))) is None
    assert value(spark, columns.safe_divide(F.lit(1), F.lit(None).cast("double"))) is None
    assert value(spark, columns.safe_divide(F.lit(1), F.lit(4))) == 0.25


def test_rounding_is_half_up_whatever_the_last_bit(spark):
    assert value(spark, columns.rounded(F.lit(0.125), 2)) == 0.13
    assert value(spark, columns.rounded(F.lit(2.675), 2)) == 2.68
    assert value(spark, columns.rounded(F.lit(28.499999999999996), 0)) == 29.0


def test_week_starts_on_monday(spark):
    assert str(value(spark, columns.week_start(F.lit("2026-07-31").cast("date")))) == "2026-07-27"
    assert value(spark, columns.sunday_based_weekday(F.lit("2026-08-02").cast("date"))) == 0


@pytest.mark.parametrize(
    "v, expected",
    [(0.28, "Critical"), (0.2799, "Warning"), (0.20, "Warning"), (0.19, "Healthy"), (None, "Unknown"), (math.nan, "Unknown")],
)
def test_error_bands_include_their_bounds(spark, v, expected):
    assert value(spark, banding.wmape_status(F.lit(v).cast("double"))) == expected


@pytest.mark.parametrize("v, expected, strict", [(0.93, "Critical", "Warning"), (0.97, "Warning", "Healthy"), (0.971, "Healthy", "Healthy")])
def test_pass_rate_bands(spark, v, expected, strict):
    assert value(spark, banding.pass_rate_status(F.lit(v))) == expected
    assert value(spark, banding.pass_rate_status_strict(F.lit(v))) == strict


def test_scorecard_band_says_watch(spark):
    assert [value(spark, banding.delivery_band(F.lit(v))) for v in (0.3, 0.2, 0.1)] == ["Critical", "Watch", "Healthy"]


def test_status_colour_takes_the_worst(spark):
    def colour(a, b):
        return value(spark, banding.status_colour(F.lit(a), F.lit(b)))

    assert colour("Healthy", "Critical") == "#A23A3A"
    assert colour("Warning", "Healthy") == "#B3791D"
    assert colour("Healthy", "Healthy") == "#3F7D5C"


def test_published_status_of_weekly_errors(spark):
    """Published weekly errors and their bands."""
    shown = [0.1313, 0.1169, 0.1242, 0.4543]
    df = spark.createDataFrame([(v,) for v in shown], "w double").select("w", banding.wmape_status("w").alias("s"))
    assert {r["w"]: r["s"] for r in rows(df)} == dict(zip(shown, ["Healthy"] * 3 + ["Critical"]))


# --- accuracy ---------------------------------------------------------------------------------------------------


def accuracy_of(spark, pairs):
    df = spark.createDataFrame(pairs, "a double, f double")
    return one(df.agg(*accuracy.error_sums("a", "f")).select(*accuracy.from_error_sums()))


def test_accuracy_measures(spark):
    got = accuracy_of(spark, [(10.0, 12.0), (20.0, 18.0), (30.0, 33.0)])
    assert got == {
        "wmape": round(7 / 60, 4),
        "mape": 0.1333,
        "bias": 0.05,
        "accuracy_pct": round((1 - 7 / 60) * 100, 2),
    }


def test_perfect_forecast_has_no_error(spark):
    assert accuracy_of(spark, [(5.0, 5.0)])["wmape"] == 0


def test_zero_actuals_have_no_relative_error(spark):
    got = accuracy_of(spark, [(0.0, 1.0), (0.0, 2.0)])
    assert got == {"wmape": None, "mape": None, "bias": None, "accuracy_pct": None}


def test_mape_skips_zero_actuals(spark):
    assert accuracy_of(spark, [(0.0, 1.0), (10.0, 15.0)])["mape"] == 0.5


def test_short_and_additive_forms_agree(spark):
    df = spark.createDataFrame([(10.0, 12.0), (0.0, 3.0), (7.0, 1.0)], "a double, f double")
    short = one(df.agg(accuracy.wmape("a", "f").alias("w"), accuracy.mape("a", "f").alias("m"), accuracy.bias("a", "f").alias("b")))
    full = accuracy_of(spark, [(10.0, 12.0), (0.0, 3.0), (7.0, 1.0)])
    assert [round(short[k], 4) for k in "wmb"] == [full["wmape"], full["mape"], full["bias"]]


# --- stock policy -----------------------------------------------------------------------------------------------


def test_safety_stock_grows_with_variance(spark):
    def stock(std, days, spread, mean):
        return value(spark, stocking.safety_stock(F.lit(mean), F.lit(std), F.lit(days), F.lit(spread), F.lit(1.65)))

    low, high = stock(1.0, 7.0, 0.5, 10.0), stock(5.0, 7.0, 3.0, 10.0)
    assert low == pytest.approx(1.65 * math.sqrt(7 + 25))
    assert high == pytest.approx(1.65 * math.sqrt(7 * 25 + 900))
    assert high > low


def test_order_quantity(spark):
    def eoq(d, c, h):
        return value(spark, stocking.economic_order_quantity(F.lit(d), F.lit(c), F.lit(h)))

    assert eoq(3650.0, 45.0, 2.2) == pytest.approx(math.sqrt(2 * 3650 * 45 / 2.2))
    assert eoq(0.0, 45.0, 2.2) == 0 and eoq(10.0, 45.0, 0.0) == 0


def test_turns_need_stock(spark):
    assert value(spark, stocking.inventory_turns(F.lit(10.0), F.lit(0.0))) is None
    assert value(spark, stocking.inventory_turns(F.lit(10.0), F.lit(4.0))) == 2.5


def test_cover_uses_a_demand_floor(spark):
    assert value(spark, stocking.days_of_supply(F.lit(5.0), F.lit(0.0))) == 50.0


# --- quantile ---------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("p", [0.0, 0.02, 0.5, 0.98, 1.0])
def test_exact_quantile_equals_interpolated_quantile(spark, p):
    rng = np.random.default_rng(3)
    data = np.concatenate([rng.normal(size=3000), np.full(1500, 0.25)])  # a third of the rows share one value
    df = spark.createDataFrame([(float(v),) for v in data], "v double")
    assert one(exact_quantile(df, "v", p))["value"] == pytest.approx(float(np.quantile(data, p)), abs=1e-12)


@pytest.mark.parametrize("n", [7, 99, 100, 101, 240, 5000])
def test_exact_quantile_on_any_number_of_rows(spark, n):
    data = np.random.default_rng(n).normal(size=n)
    df = spark.createDataFrame([(float(v),) for v in data], "v double")
    for p in (0.1, 0.98):
        assert one(exact_quantile(df, "v", p))["value"] == pytest.approx(float(np.quantile(data, p)), abs=1e-12)


def test_exact_quantile_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert one(exact_quantile(df, "v", 0.5))["value"] is None


def test_exact_quantile_of_one_row(spark):
    df = spark.createDataFrame([(7.0,)], "v double")
    assert one(exact_quantile(df, "v", 0.98))["value"] == 7.0


def test_quantiles_from_counts_over_many_parts(spark):
    rng = np.random.default_rng(8)
    data = {"a": rng.normal(size=4000).round(2), "b": np.concatenate([np.zeros(700), rng.exponential(size=1300)])}
    rows_ = [(g, float(v)) for g, values in data.items() for v in values]
    counts = spark.createDataFrame(rows_, "g string, v double").groupBy("g", "v").agg(F.count("*").alias("n"))
    spread = durable(counts.repartitionByRange(6, "g", "v").withColumn("part", F.spark_partition_id()), "parts")
    assert spread.select("part").distinct().count() > 3
    ps = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    for df in (spread, durable(range_parts(counts, "g", "v"), "parts")):
        got = {r["g"]: r for r in rows(quantiles_from_counts(df, "g", "v", "n", ps))}
        for g, values in data.items():
            assert got[g]["rows"] == len(values)
            np.testing.assert_allclose(got[g]["quantiles"], np.quantile(values, ps), atol=1e-12)
