import pytest

from helpers import one, rows
from stockloom.operators import quality
from stockloom.functions.stocking import category_z
from stockloom.sources.tables import read_service_levels, service_level_seed


def rule(id_, table, field, expectation, threshold=1.0, severity="high", **extra):
    return {"id": id_, "table": table, "field": field, "expectation": expectation, "threshold": threshold, "severity": severity, **extra}


def tables(spark):
    return {
        "t": spark.createDataFrame(
            [("a", 1.0, "p"), ("a", -1.0, "q"), ("b", None, None), (None, 250.0, "zz")], "k string, v double, ref string"
        ),
        "parent": spark.createDataFrame([("p",), ("q",), ("q",), (None,)], "id string"),
        "empty": spark.createDataFrame([], "k string"),
        "clean": spark.createDataFrame([("x",), ("y",)], "k string"),
    }


def test_every_expectation(spark):
    rules = [
        rule("1", "t", "k", "not_null", 0.75),
        rule("2", "t", "k", "unique_and_not_null"),
        rule("3", "t", "v", "non_negative"),
        rule("4", "t", "v", "below_250"),
        rule("5", "t", "v", "between_-1_and_1"),
        rule("6", "t", "ref", "referential_parent", reference={"table": "parent", "field": "id"}),
        rule("7", "t", "v", "something_else"),
        rule("8", "nowhere", "v", "not_null"),
        rule("9", "t", "nothing", "not_null"),
        rule("A", "empty", "k", "not_null"),
        rule("B", "empty", "k", "unique_and_not_null"),
        rule("C", "clean", "k", "unique_and_not_null", severity="critical"),
    ]
    got = {r["id"]: (r["pass_rate"], r["rows_checked"], r["rows_failed"], r["passed"]) for r in rows(quality.run_quality_rules(spark, tables(spark), rules))}
    assert got == {
        "1": (0.75, 4, 1, True),
        "2": (0.25, 4, 3, False),  # both copies of a repeated key fail, and the missing one
        "3": (0.75, 4, 1, False),
        "4": (0.75, 4, 1, False),  # the bound itself fails
        "5": (0.75, 4, 1, False),  # both bounds pass
        "6": (0.5, 4, 2, False),  # a missing reference fails
        "7": (1.0, 4, 0, True),
        "8": (None, 0, None, False),
        "9": (None, 0, None, False),
        "A": (None, 0, 0, False),
        "B": (None, 0, 0, False),
        "C": (1.0, 2, 0, True),
    }


def test_gate_stops_on_critical_failures_only(spark):
    ok = quality.run_quality_rules(spark, tables(spark), [rule("1", "t", "k", "not_null"), rule("2", "clean", "k", "not_null", severity="critical")])
    quality.quality_gate(ok)
    bad = quality.run_quality_rules(spark, tables(spark), [rule("1", "t", "k", "not_null", severity="critical")])
    with pytest.raises(quality.QualityGateError, match="1"):
        quality.quality_gate(bad)


def test_rule_library(spark, tmp_path):
    import yaml

    assert len(quality.RULES) == 11 and len({r["id"] for r in quality.RULES}) == 11
    path = tmp_path / "rules.yml"
    path.write_text(yaml.safe_dump({"rules": quality.RULES}))
    assert quality.load_rules(str(path)) == quality.RULES


def test_status_and_owner(spark):
    results = spark.createDataFrame(
        [("a", 1.0, True), ("a", 0.9, False), ("b", None, False)], "owner string, pass_rate double, passed boolean"
    )
    assert one(quality.quality_status(results)) == {"dq_pass_rate": 0.95, "dq_rules_failing": 2, "dq_status": "Warning"}
    owners = {r["owner"]: (r["rules"], r["rules_failing"]) for r in rows(quality.quality_by_owner(results))}
    assert owners == {"a": (2, 1), "b": (1, 1)}


def test_master_data(spark):
    products = spark.createDataFrame([("P1",), ("P1",), (None,), (None,)], "product_id string")
    skus = spark.createDataFrame([("A", "P1"), ("B", "PX"), ("C", None)], "sku_id string, product_id string")
    stores = spark.createDataFrame([("W",)], "warehouse_id string")
    suppliers = spark.createDataFrame([("V",)], "supplier_id string")
    orders = spark.createDataFrame([("A",), ("SKU-99999",)], "sku_id string")
    got = {r["check"]: (r["passed"], r["detail"]) for r in rows(quality.master_data_checks(products, skus, stores, stores, suppliers, orders))}
    assert got == {
        "product_id uniqueness": (False, "2 duplicates"),
        "sku references known product_id": (False, "2 orphaned SKUs"),
        "store references known warehouse_id": (True, "0 orphaned stores"),
        "supplier_id uniqueness": (True, "no duplicates"),
        "purchase order references known sku_id": (False, "1 purchase orders reference an unknown SKU"),
    }


def test_override_summary(spark):
    df = spark.createDataFrame(
        [(True, "short"), (True, "short"), (True, "late"), (False, ""), (False, "short")], "override_flag boolean, override_reason string"
    )
    assert one(quality.override_summary(df)) == {
        "total_decisions": 5, "override_count": 3, "override_rate": 0.6, "auto_approved_rate": 0.4,
        "override_reasons": {"short": 2, "late": 1},
    }
    assert one(quality.override_summary(df.limit(0)))["override_rate"] is None
    assert {r["override_reason"]: r["decisions"] for r in rows(quality.override_reasons(df))} == {"short": 2, "late": 1}


def test_failing_rows(spark):
    df = spark.createDataFrame([(None, -1), ("a", 0)], "k string, n int")
    assert quality.rows_with_null(df, "k").count() == 1 and quality.rows_below_zero(df, "n").count() == 1


def test_service_levels(spark, tmp_path):
    seed = service_level_seed(spark)
    assert {r["category"]: r["target_service_level"] for r in rows(seed)}["Dairy"] == 0.97
    assert {r["category"]: r["z"] for r in rows(category_z(seed))} == {"Beverages": 1.64, "Snacks": 1.64, "Dairy": 1.88, "Household": 1.28, "Personal Care": 1.28, "Frozen": 1.64}
    assert all(r["rationale"] for r in rows(seed))
    path = tmp_path / "levels.csv"
    path.write_text("category,target_service_level,rationale\nDairy,0.97,short life\n")
    assert one(read_service_levels(spark, str(path)))["target_service_level"] == 0.97
