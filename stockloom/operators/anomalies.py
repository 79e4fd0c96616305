"""Implausible stock positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.functions.banding import DEFAULTS
from stockloom.functions.columns import iso_date, month_start
from stockloom.functions.quantiles import exact_quantile
from stockloom.operators.isolation import IsolationForestModel, fit_isolation_forest
from stockloom.operators.series import with_lookback
from stockloom.sources.durable import durable

# Model inputs, in order.
FEATURES = [
    "on_hand_units",
    "on_order_units",
    "days_of_supply",
    "dos_rolling_mean",
    "dos_rolling_std",
    "dos_change",
]
SERIES = ["location_id", "sku_id"]


def stock_features(snapshots: DataFrame, date: str = "date") -> DataFrame:
    """Trailing mean, deviation and step of days of supply per location and SKU, and the negative-stock flag."""
    ties = ["location_type", "on_hand_units", "on_order_units", "safety_stock_units"]

    def columns(w) -> dict[str, Column]:
        last_four = w.rowsBetween(-3, 0)
        return {
            "dos_rolling_mean": F.avg("days_of_supply").over(last_four),
            "dos_rolling_std": F.coalesce(F.stddev_samp("days_of_supply").over(last_four), F.lit(0.0)),
            "dos_change": F.coalesce(F.col("days_of_supply") - F.lag("days_of_supply").over(w), F.lit(0.0)),
        }

    order = [date, *[t for t in ties if t in snapshots.columns]]
    featured = with_lookback(snapshots, SERIES, order, ["days_of_supply"], 3, month_start(date), columns)
    return featured.withColumn("is_negative_on_hand", F.coalesce(F.col("on_hand_units") < 0, F.lit(False)))


def classify_anomalies(
    scored: DataFrame, contamination: float = DEFAULTS.contamination, score: str = "anomaly_score", date: str = "date"
) -> DataFrame:
    """Rows at or above the score quantile, or with negative stock, with their type; highest score first.

    ``scored`` is read three times; hand in a written table when the score is expensive.
    """
    threshold = exact_quantile(scored, score, 1 - contamination).scalar()
    negative, change = F.col("is_negative_on_hand"), F.col("dos_change")
    kind = (
        F.when(negative, "Negative on-hand (data defect)")
        .when(change < -3, "Unexplained inventory drop")
        .when(change > 3, "Unexplained inventory build-up")
        .otherwise("Abnormal stock position")
    )
    return (
        scored.where((F.col(score) >= threshold) | negative)
        .select(
            iso_date(date).alias("date"),
            "location_type",
            "location_id",
            "sku_id",
            "on_hand_units",
            "on_order_units",
            "days_of_supply",
            F.col(score).alias("anomaly_score"),
            kind.alias("anomaly_type"),
        )
        .orderBy(F.col("anomaly_score").desc(), "location_id", "sku_id", "date")
    )


def score_positions(
    snapshots: DataFrame, trees: int = 200, seed: int = 42, date: str = "date", sample: int = 256
) -> tuple[IsolationForestModel, DataFrame]:
    """Isolation forest on the stock features. Features and scores are written once; later steps re-read them."""
    features = durable(stock_features(snapshots, date), "stock-features")
    model = fit_isolation_forest(features, [date, "location_type", *SERIES], FEATURES, trees, sample, seed)
    return model, durable(model.score(features), "stock-scores")


def detect_anomalies(
    snapshots: DataFrame,
    contamination: float = DEFAULTS.contamination,
    trees: int = 200,
    seed: int = 42,
    date: str = "date",
    sample: int = 256,
) -> DataFrame:
    """Anomalous stock positions by an isolation forest; each tree grows on ``sample`` rows, whatever the table's size."""
    _, scored = score_positions(snapshots, trees, seed, date, sample)
    return classify_anomalies(scored, contamination, date=date)
