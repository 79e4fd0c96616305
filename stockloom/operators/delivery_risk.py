"""Risk that a purchase order arrives late."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockloom.functions.banding import DEFAULTS
from stockloom.functions.columns import rounded, safe_divide
from stockloom.functions.quantiles import range_parts
from stockloom.operators.boosting import LOGISTIC, BoostedTrees, fit_boosted_trees
from stockloom.sources.durable import drop_tables, durable

# Model inputs, in order.
FEATURES = [
    "reliability_score",
    "quantity_ordered",
    "quoted_lead_time_days",
    "order_month",
    "region_enc",
    "category_enc",
]

BROADCAST_ROWS = 1_000_000  # up to so many SKUs or suppliers are sent to each executor


def order_features(orders: DataFrame, suppliers: DataFrame, skus: DataFrame) -> DataFrame:
    """Late flag, quoted lead time, month and supplier and product attributes of orders for known SKUs."""
    known = skus.select("sku_id", "category")
    source = suppliers.select("supplier_id", "reliability_score", "region_of_origin")
    return (
        orders.join(known, "sku_id")
        .join(source, "supplier_id", "left")
        .withColumn(
            "is_late",
            F.coalesce(F.col("actual_delivery_date") > F.col("expected_delivery_date"), F.lit(False)).cast("int"),
        )
        .withColumn("quoted_lead_time_days", F.datediff("expected_delivery_date", "order_date"))
        .withColumn("order_month", F.month("order_date"))
    )


def in_holdout(key: str, label: str, share: float, seed: int) -> Column:
    """Repeatable hold-out by the MD5 sum of key and class, so each class loses the same share of its rows."""
    text = F.concat_ws("|", F.lit(str(seed)), F.col(label).cast("string"), F.col(key).cast("string"))
    number = F.conv(F.left(F.md5(text.cast("binary")), F.lit(8)), 16, 10).cast("bigint")
    return number < F.lit(int(share * (1 << 32)))


@dataclass
class RiskResult:
    model: BoostedTrees
    metrics: DataFrame
    importance: DataFrame
    scored: DataFrame
    supplier_risk: DataFrame


def encoded(df: DataFrame, column: str, code: str) -> DataFrame:
    """``df`` with the place of a value among all values in alphabetical order; -1 for a missing one.

    The distinct values (regions, categories) are few; they are ranked by themselves, written, so that their size is known
    and the rows of ``df`` need not move, and joined back.
    """
    kinds = df.select(F.col(column).alias("kind")).where("kind is not null").distinct()
    ranked = kinds.select("kind", (F.row_number().over(Window.orderBy("kind")) - 1).cast("double").alias(code))
    ranked = durable(ranked, "kinds")
    return df.join(ranked, F.col(column) == F.col("kind"), "left").drop("kind").withColumn(code, F.coalesce(code, F.lit(-1.0)))


def written(df: DataFrame, name: str) -> DataFrame:
    """A dimension as a table of known size, which is sent to the rows that look it up unless it is a large one."""
    table = durable(df, name)
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def train_delivery_risk(
    orders: DataFrame,
    suppliers: DataFrame,
    skus: DataFrame,
    rounds: int = 180,
    depth: int = 3,
    step: float = 0.08,
    holdout: float = 0.25,
    seed: int = 42,
) -> RiskResult:
    """Classifier, hold-out metrics, feature importance, scored orders and the risk by supplier, from one fit.

    The orders are written twice, with their features and with their scores; the first table is deleted then.
    """
    spark = orders.sparkSession
    suppliers = written(suppliers.select("supplier_id", "reliability_score", "region_of_origin"), "order-suppliers")
    skus = written(skus.select("sku_id", "category"), "order-skus")
    features = order_features(orders, suppliers, skus).withColumn("in_holdout", in_holdout("po_id", "is_late", holdout, seed))
    features = durable(features, "order-features")
    frame = encoded(encoded(features, "region_of_origin", "region_enc"), "category", "category_enc")
    model = fit_boosted_trees(
        frame.where(~F.col("in_holdout")), FEATURES, "is_late", LOGISTIC, rounds, step, 1 << depth, depth, l2=0.0, min_leaf=1
    )
    scored = durable(model.score(frame, "late_risk_score").drop("region_enc", "category_enc"), "order-risk")
    drop_tables(features)
    metrics = scored.agg(
        F.count_if(~F.col("in_holdout")).alias("n_train"),
        F.count_if("in_holdout").alias("n_test"),
        rounded(F.avg("is_late"), 4).alias("base_late_rate"),
    ).crossJoin(holdout_auc(scored))
    importance = spark.createDataFrame(
        list(zip(FEATURES, model.importance(), strict=True)), "feature string, importance double"
    ).orderBy(F.col("importance").desc(), "feature")
    return RiskResult(model, metrics.select("auc", "n_train", "n_test", "base_late_rate"), importance, scored, supplier_risk(scored))


def holdout_auc(scored: DataFrame) -> DataFrame:
    """One row, ``auc``: area under the ROC curve on the hold-out (4 decimals), NULL when it has one class only.

    By rank sums: a score counts for each late order the punctual ones below it, and half of those beside it. Orders are
    added up by score, the scores are spread over the tasks in their order, and only one total of each task is ordered
    centrally.
    """
    late, punctual = F.sum("is_late"), F.sum(1 - F.col("is_late"))
    by_score = scored.where("in_holdout").groupBy(F.lit(0).alias("g"), F.col("late_risk_score").alias("v")).agg(late.alias("late"), punctual.alias("punctual"))
    counts = durable(range_parts(by_score, "g", "v"), "score-counts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = counts.groupBy("part").agg(F.sum("punctual").alias("inside"))
    parts = parts.select("part", F.coalesce(F.sum("inside").over(before), F.lit(0)).alias("offset"))
    upto = F.col("offset") + F.sum("punctual").over(Window.partitionBy("part").orderBy("v"))
    below = F.col("late") * (upto - F.col("punctual") / 2)
    ranked = counts.join(parts, "part").select("late", "punctual", below.alias("below"))
    pairs = F.sum("late").cast("double") * F.sum("punctual")
    return ranked.agg(rounded(safe_divide(F.sum("below"), pairs), 4).alias("auc"))


def supplier_risk(scored: DataFrame) -> DataFrame:
    """Orders, observed and predicted late rate per supplier, highest predicted risk first."""
    return (
        scored.groupBy("supplier_id")
        .agg(
            F.count("po_id").alias("orders"),
            F.avg("is_late").alias("observed_late_rate"),
            F.avg("late_risk_score").alias("avg_predicted_risk"),
            F.max("reliability_score").alias("reliability_score"),
        )
        .orderBy(F.col("avg_predicted_risk").desc(), "supplier_id")
    )


def risk_review_queue(scored: DataFrame, limit: float = DEFAULTS.review_risk) -> DataFrame:
    """Orders whose predicted risk is above the review bound."""
    return scored.where(F.col("late_risk_score") > limit).orderBy(F.col("late_risk_score").desc(), "po_id")
