import json
import os

import pytest

from checks.oracle import ORACLE
from checks.queries import QUERIES
from helpers import one, rows
from stockloom.plans.full_run import run_all
from stockloom.plans.warehouse import build_warehouse
from stockloom.operators.quality import QualityGateError
from stockloom.sources import tables
from stockloom.sources.durable import durable, shared_folder
from stockloom.sources.retail_tables import RetailTables
from stockloom.sources.schemas import RAW_SCHEMAS

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")


@pytest.fixture(scope="module")
def raw(spark):
    return RetailTables(spark, DATA).tables()


@needs_data
def test_raw_tables_match_their_declared_schemas(spark, raw):
    for name, df in raw.items():
        declared = spark.createDataFrame([], RAW_SCHEMAS[name]).dtypes
        assert df.dtypes == declared, name


@needs_data
def test_csv_round_trip(spark, raw, tmp_path):
    names = ["holidays", "promotions", "stores"]
    tables.write_raw({n: raw[n] for n in names}, str(tmp_path))
    back = tables.read_raw(spark, str(tmp_path), names)
    for n in names:
        assert back[n].dtypes == raw[n].dtypes
        assert back[n].exceptAll(raw[n]).count() == 0 and back[n].count() == raw[n].count()


def test_bad_csv_fails_loudly(spark, tmp_path):
    folder = tmp_path / "stores.csv"
    folder.mkdir()
    (folder / "x.csv").write_text("store_id,region,warehouse_id,store_format,size_sqm,open_date\nS,N,W,Metro,not a number,2026-01-01\n")
    with pytest.raises(Exception, match="(?i)malformed|number"):
        tables.read_raw(spark, str(tmp_path), ["stores"])["stores"].collect()


@needs_data
def test_layers_are_partitioned_and_registered(spark, raw, tmp_path):
    layers = build_warehouse(spark, raw, str(tmp_path))
    assert any(f.startswith("load_month=") for f in os.listdir(tmp_path / "gold" / "fact_daily_sales"))
    assert one(spark.sql("select count(*) as n from gold_fact_daily_sales"))["n"] == layers["gold"]["fact_daily_sales"].count()
    assert spark.sql("select * from bronze_stores").count() == 5
    with pytest.raises(QualityGateError, match="DQ-006"):
        build_warehouse(spark, raw, str(tmp_path / "gated"), enforce_gate=True)
    assert not (tmp_path / "gated" / "gold").exists()


def test_durable_results_live_in_the_shared_folder(spark):
    out = durable(spark.range(3), "three")
    assert out.count() == 3
    assert shared_folder(spark) in out.inputFiles()[0]


def test_flat_csv_turns_nested_columns_into_text(spark):
    df = spark.sql("select map('a', 1) as m, array(1, 2) as l, 1 as n")
    assert one(tables.flat_csv(df)) == {"m": '{"a":1}', "l": "[1,2]", "n": 1}


@needs_data
def test_full_run(spark, raw, tmp_path):
    out = run_all(spark, raw, str(tmp_path), forecast_rounds=3, risk_rounds=3, trees=10)
    assert len([d for d in os.listdir(tmp_path / "datasets")]) == 22
    assert set(os.listdir(tmp_path / "samples")) == {"supplier_scorecard", "inventory_health_summary"}
    assert set(os.listdir(tmp_path / "models")) == {"demand", "delivery_risk"}
    (part,) = [f for f in os.listdir(tmp_path / "run_summary") if f.endswith(".json")]
    summary = json.loads((tmp_path / "run_summary" / part).read_text())
    assert len(summary["rows"]) == 17 and len(summary["reconciliation"]) == 11
    assert "DQ-006" in summary["governance"]["data_quality_rules_failed"]
    assert summary["governance"]["master_data_checks_failed"] == ["purchase order references known sku_id"]
    assert summary["inventory_anomalies_detected"] == out["inventory_anomalies"].count()
    assert 0 <= summary["risk"]["auc"] <= 1
    assert summary["overrides"]["override_reasons"]
    assert len(rows(out["data_quality_results"])) == 11


def test_every_query_has_sql_or_a_reason():
    models = {
        "boosted_tree_forecast",
        "reconcile_all_methods",
        "isolation_forest_anomalies",
        "delivery_risk_metrics",
        "delivery_risk_importance",
        "supplier_delivery_risk",
    }
    assert set(QUERIES) - set(ORACLE) == models and not set(ORACLE) - set(QUERIES)


SAMPLE = [
    "silver_daily_sales",
    "gold_dim_date",
    "supplier_scorecard",
    "inventory_health",
    "weekly_demand_panel",
    "smoothing_forecast",
    "reconcile_top_down_every_pair",
    "scenario_summary",
    "warehouse_allocation",
    "promotion_uplift",
    "stock_features",
    "anomalies_by_step",
    "quality_rules",
    "demand_drift",
    "business_kpis",
    "stockout_rate_year_over_year",
]


@needs_data
@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, name):
    from checks.compare import compare, connect

    assert compare(spark, connect(DATA), QUERIES[name], ORACLE[name], DATA) == ""


def test_written_results_leave_no_shuffle_files(spark):
    import time

    def shuffled():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle")}

    from stockloom.llm.common import stored

    for write in (durable, stored):
        before = shuffled()
        df = spark.range(50_000).repartition(7, "id").groupBy("id").count()
        kept = write(df, "shuffled")
        until = time.time() + 20
        while (left := shuffled() - before) and time.time() < until:
            time.sleep(0.2)
        assert not left and kept.count() == 50_000
        assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None
