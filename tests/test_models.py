import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import day, one, rows
from stockloom.operators import anomalies, delivery_risk, isolation
from stockloom.operators.boosting import BoostedTrees

IDS, FEATURES = ["i"], ["x", "y"]


def cloud(spark, n, outliers=3, seed=2):
    rng = np.random.default_rng(seed)
    points = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(size=(n, 2)))]
    points += [(n + k, 8.0 + k, -8.0 - k) for k in range(outliers)]
    return spark.createDataFrame(points, "i bigint, x double, y double")


def test_outliers_get_the_highest_scores(spark):
    df = cloud(spark, 2000)
    model = isolation.fit_isolation_forest(df, IDS, FEATURES, trees=60)
    scored = model.score(df, "s").toPandas().sort_values("s", ascending=False)
    assert set(scored.i[:3]) == {2000, 2001, 2002}
    assert 0 < scored.s.min() and scored.s.max() <= 1 and scored.s.median() < 0.5
    again = isolation.fit_isolation_forest(df.repartition(5), IDS, FEATURES, trees=60).score(df, "s").toPandas().sort_values("s", ascending=False)
    assert list(again.s) == list(scored.s)


@pytest.mark.parametrize("n", [100, 3000, 100_000])
def test_each_tree_sees_a_bounded_sample(spark, n):
    df = spark.range(n).selectExpr("id as i", "double(id) as x", "double(-id) as y")
    sizes = [r["count"] for r in isolation.tree_samples(df, IDS, FEATURES, n, 20, 256, 42).groupBy("tree").count().collect()]
    assert len(sizes) == 20 and max(sizes) <= 256 and min(sizes) >= min(n, 200)


def test_sampling_of_many_rows_takes_the_thinning_branch(spark):
    df = spark.range(300_000).selectExpr("id as i", "double(id) as x", "double(-id) as y")
    sizes = [r["count"] for r in isolation.tree_samples(df, IDS, FEATURES, 300_000, 50, 16, 42).groupBy("tree").count().collect()]
    assert len(sizes) == 50 and max(sizes) == 16 and min(sizes) == 16


def test_constant_features_still_score(spark):
    df = spark.range(50).selectExpr("id as i", "1D as x", "cast(null as double) as y")
    scores = {r["s"] for r in isolation.fit_isolation_forest(df, IDS, FEATURES, trees=5).score(df, "s").select("s").collect()}
    assert len(scores) == 1


def scored_stock(spark):
    values = [("A", 5.0, 0.0, 0.1), ("B", -1.0, 5.0, 0.2), ("C", 5.0, -4.0, 0.95), ("D", 5.0, 4.0, 0.97), ("E", 5.0, 0.0, 0.99)]
    filler = [(f"Z{i}", 5.0, 9.0, 0.3) for i in range(95)]
    d = day("2026-01-01")
    return spark.createDataFrame(
        [(d, "Store", "S", k, on, 0.0, 1.0, change, on < 0, s) for k, on, change, s in values + filler],
        "date date, location_type string, location_id string, sku_id string, on_hand_units double, on_order_units double, "
        "days_of_supply double, dos_change double, is_negative_on_hand boolean, anomaly_score double",
    )


def test_anomaly_classes_and_order(spark):
    got = rows(anomalies.classify_anomalies(scored_stock(spark), contamination=0.03))
    assert [(r["sku_id"], r["anomaly_type"]) for r in got] == [
        ("E", "Abnormal stock position"),
        ("D", "Unexplained inventory build-up"),
        ("C", "Unexplained inventory drop"),
        ("B", "Negative on-hand (data defect)"),
    ]
    assert got[0]["date"] == "2026-01-01"


def test_detector_flags_negative_stock(spark):
    rng = np.random.default_rng(0)
    lines = []
    for k in range(4):
        for i in range(60):
            on_hand = float(rng.normal(50, 5)) if (k, i) != (2, 30) else -7.0
            lines.append((dt.date(2026, 1, 1) + dt.timedelta(days=i), "Store", "S", f"K{k}", on_hand, 1.0, 1.0, on_hand / 10))
    from stockloom.sources.schemas import RAW_SCHEMAS

    df = spark.createDataFrame(lines, RAW_SCHEMAS["inventory_snapshots"])
    got = rows(anomalies.detect_anomalies(df, trees=20))
    assert "Negative on-hand (data defect)" in {r["anomaly_type"] for r in got}
    assert 5 <= len(got) <= 7  # two per cent of 240, the negative row included
    assert [r["anomaly_score"] for r in got] == sorted((r["anomaly_score"] for r in got), reverse=True)


def orders(spark, n=800):
    rng = np.random.default_rng(4)
    out = []
    for i in range(n):
        supplier = f"V{i % 4}"
        ordered = dt.date(2026, 1, 1) + dt.timedelta(days=int(rng.integers(0, 300)))
        expected = ordered + dt.timedelta(days=int(rng.integers(5, 20)))
        late = rng.random() < (0.7 if supplier == "V0" else 0.1)
        actual = expected + dt.timedelta(days=3 if late else 0)
        sku = "GONE" if i == 0 else f"K{i % 3}"
        out.append((f"P{i}", supplier, sku, ordered, expected, actual, float(rng.integers(1, 500))))
    return spark.createDataFrame(
        out,
        "po_id string, supplier_id string, sku_id string, order_date date, expected_delivery_date date, actual_delivery_date date, quantity_ordered double",
    )


def masters(spark):
    suppliers = spark.createDataFrame(
        [("V0", 0.6, "N"), ("V1", 0.9, "S"), ("V2", 0.95, None)], "supplier_id string, reliability_score double, region_of_origin string"
    )
    skus = spark.createDataFrame([("K0", "X"), ("K1", "Y"), ("K2", "X")], "sku_id string, category string")
    return suppliers, skus


def test_delivery_risk_model(spark, tmp_path):
    result = delivery_risk.train_delivery_risk(orders(spark), *masters(spark), rounds=8)
    metrics = one(result.metrics)
    assert 0.6 < metrics["auc"] <= 1
    assert metrics["n_train"] + metrics["n_test"] == 799
    assert 0.2 < metrics["n_test"] / 799 < 0.3
    importance = rows(result.importance)
    assert [r["feature"] for r in importance] != [] and len(importance) == 6
    assert sum(r["importance"] for r in importance) == pytest.approx(1)
    risk = rows(result.supplier_risk)
    assert risk[0]["supplier_id"] == "V0" and risk[0]["observed_late_rate"] > 0.5
    assert one(result.scored.agg(F.min("late_risk_score").alias("a"), F.max("late_risk_score").alias("b")))["b"] <= 1
    queue = rows(delivery_risk.risk_review_queue(result.scored))
    assert all(r["late_risk_score"] > 0.3 for r in queue)

    result.model.save(spark, str(tmp_path / "m"))
    back = BoostedTrees.load(spark.newSession(), str(tmp_path / "m"), delivery_risk.FEATURES)
    assert back.trees == result.model.trees and back.base == result.model.base


def test_auc_by_rank_sums(spark):
    rng = np.random.default_rng(8)
    late = rng.integers(0, 2, 500)
    score = np.round(rng.random(500) * 0.7 + 0.3 * late, 2)  # with ties
    df = spark.createDataFrame([(int(a), float(s), i % 5 > 0) for i, (a, s) in enumerate(zip(late, score, strict=True))], "is_late int, late_risk_score double, in_holdout boolean")
    held = np.arange(500) % 5 > 0
    a, b = score[held & (late == 1)], score[held & (late == 0)]
    pairs = (a[:, None] > b).mean() + 0.5 * (a[:, None] == b).mean()
    assert one(delivery_risk.holdout_auc(df.repartition(7)))["auc"] == pytest.approx(pairs, abs=5e-5)
    assert one(delivery_risk.holdout_auc(df.limit(0)))["auc"] is None


def test_encoding_is_alphabetical(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("c",), ("b",)], "kind_of string")
    assert sorted((r.kind_of or "", r.code) for r in delivery_risk.encoded(df, "kind_of", "code").collect()) == [("", -1.0), ("a", 0.0), ("b", 1.0), ("b", 1.0), ("c", 2.0)]


def test_single_class_has_no_auc(spark):
    df = spark.createDataFrame([(1, 0.5, True), (1, 0.6, True)], "is_late int, late_risk_score double, in_holdout boolean")
    assert one(delivery_risk.holdout_auc(df))["auc"] is None


def test_task_code_travels_without_the_package():
    """Executors must not need this package: functions of the task modules are sent by value."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    from stockloom.operators import forecasting

    payload = cloudpickle.dumps(forecasting._smooth).hex()
    code = (
        "import pickle, numpy as np; f = pickle.loads(bytes.fromhex('" + payload + "')); "
        "print(f(np.arange(20.0), np.array([[0.5, 0.1, 0.9]]))[2])"
    )
    out = subprocess.run([sys.executable, "-c", code], cwd="/", capture_output=True, text=True, timeout=60)
    assert out.stdout.strip() == "0.9", out.stderr


MODEL_QUERIES = {
    "boosted_tree_forecast": "forecasting.forecast_boosted_trees",
    "reconcile_all_methods": "forecasting.forecast_boosted_trees",
    "isolation_forest_anomalies": "anomalies.detect_anomalies",
    "delivery_risk_metrics": "delivery_risk.train_delivery_risk",
    "delivery_risk_importance": "delivery_risk.train_delivery_risk",
    "supplier_delivery_risk": "delivery_risk.train_delivery_risk",
}


@pytest.mark.parametrize("name", MODEL_QUERIES)
def test_registered_model_queries_use_the_library_defaults(spark, monkeypatch, name):
    from checks import queries

    class Reached(Exception):
        pass

    def model(*tables, **settings):
        raise Reached(settings)

    module, function = MODEL_QUERIES[name].split(".")
    monkeypatch.setattr(getattr(queries, module), function, model)
    with pytest.raises(Reached) as reached:
        queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert reached.value.args[0] == {}


def test_orders_stay_where_they_are_when_features_are_looked_up(spark, monkeypatch):
    """SKUs and suppliers go to the orders whatever the plan expects of their size; one table of orders is left in the end."""
    import os

    from stockloom.sources.durable import durable

    plans, kept = {}, {}

    def keep(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        kept[name] = durable(df, name)
        return kept[name]

    monkeypatch.setattr(delivery_risk, "durable", keep)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = delivery_risk.train_delivery_risk(orders(spark), *masters(spark), rounds=2)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plans["order-features"]
    assert "SortMergeJoin" not in plans["order-features"] and "Exchange hashpartitioning" not in plans["order-features"]
    assert result.scored.count() == one(result.supplier_risk.agg(F.sum("orders").alias("n")))["n"] > 0
    folder = kept["order-features"].inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
    assert not os.path.exists(folder)
