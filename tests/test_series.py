import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import rows
from stockloom.functions.columns import month_start
from stockloom.operators.anomalies import stock_features
from stockloom.operators.series import with_lookback


def random_series(spark, n=900, seed=1):
    """One series holds most rows, one is short, one has long gaps."""
    rng = np.random.default_rng(seed)
    out = []
    for key, count, gap in (("hot", n, 1), ("short", 2, 1), ("gappy", 40, 45)):
        start = dt.date(2024, 1, 1)
        for i in range(count):
            out.append((key, start + dt.timedelta(days=i * gap), float(rng.normal())))
    return spark.createDataFrame(out, "k string, d date, v double")


def test_chunked_window_equals_window_over_the_whole_series(spark):
    df = random_series(spark)

    def add(w):
        return {"lag2": F.lag("v", 2).over(w), "mean": F.avg("v").over(w.rowsBetween(-3, 0)), "n": F.count("v").over(w.rowsBetween(-3, 0))}

    chunked = with_lookback(df, ["k"], ["d"], ["v"], 3, month_start("d"), add)
    plain = df.withColumns(add(Window.partitionBy("k").orderBy("d")))
    a, b = rows(chunked, "k", "d"), rows(plain.select(*chunked.columns), "k", "d")
    assert len(a) == df.count() == len(b)
    for x, y in zip(a, b):
        assert x.keys() == y.keys() and x["lag2"] == y["lag2"] and x["n"] == y["n"] and abs(x["mean"] - y["mean"]) < 1e-12


def test_stock_features_equal_pandas(spark):
    df = random_series(spark).selectExpr(
        "d as date", "'Store' as location_type", "k as location_id", "'A' as sku_id", "v as on_hand_units",
        "0D as on_order_units", "0D as safety_stock_units", "v as days_of_supply",
    )
    got = stock_features(df).toPandas().sort_values(["location_id", "date"]).reset_index(drop=True)
    pdf = df.toPandas().sort_values(["location_id", "date"]).reset_index(drop=True)
    group = pdf.groupby("location_id")["days_of_supply"]
    pd.testing.assert_series_equal(
        got.dos_rolling_mean, group.transform(lambda s: s.rolling(4, min_periods=1).mean()), check_names=False
    )
    pd.testing.assert_series_equal(
        got.dos_rolling_std, group.transform(lambda s: s.rolling(4, min_periods=2).std()).fillna(0), check_names=False
    )
    pd.testing.assert_series_equal(got.dos_change, group.diff().fillna(0), check_names=False)
    assert (got.is_negative_on_hand == (pdf.on_hand_units < 0)).all()
