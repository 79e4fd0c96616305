"""Declarative data-quality rules, master-data checks and override tracking."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom.functions.banding import pass_rate_status
from stockloom.functions.columns import count_true, rounded, safe_divide

# Fixed values of the rule library.
RULES: list[dict] = [
    {"id": "DQ-001", "table": "products", "field": "product_id", "expectation": "unique_and_not_null",
     "threshold": 1.00, "severity": "critical", "owner": "Product Data Steward",
     "description": "Product identifiers are present and unique"},
    {"id": "DQ-002", "table": "skus", "field": "sku_id", "expectation": "unique_and_not_null",
     "threshold": 1.00, "severity": "critical", "owner": "Product Data Steward",
     "description": "SKU identifiers are present and unique"},
    {"id": "DQ-003", "table": "suppliers", "field": "supplier_id", "expectation": "unique_and_not_null",
     "threshold": 1.00, "severity": "critical", "owner": "Supplier Data Steward",
     "description": "Supplier identifiers are present and unique"},
    {"id": "DQ-004", "table": "skus", "field": "product_id", "expectation": "referential_product",
     "reference": {"table": "products", "field": "product_id"},
     "threshold": 1.00, "severity": "critical", "owner": "Product Data Steward",
     "description": "SKUs belong to a known product"},
    {"id": "DQ-005", "table": "stores", "field": "warehouse_id", "expectation": "referential_warehouse",
     "reference": {"table": "warehouses", "field": "warehouse_id"},
     "threshold": 1.00, "severity": "critical", "owner": "Location Data Steward",
     "description": "Stores are supplied by a known warehouse"},
    {"id": "DQ-006", "table": "purchase_orders", "field": "sku_id", "expectation": "referential_sku",
     "reference": {"table": "skus", "field": "sku_id"},
     "threshold": 1.00, "severity": "critical", "owner": "Supply Chain Data Steward",
     "description": "Purchase orders name a known SKU"},
    {"id": "DQ-007", "table": "products", "field": "unit_cost", "expectation": "not_null",
     "threshold": 0.98, "severity": "high", "owner": "Finance Data Steward",
     "description": "Products carry a unit cost"},
    {"id": "DQ-008", "table": "daily_sales", "field": "revenue", "expectation": "not_null",
     "threshold": 0.98, "severity": "high", "owner": "Sales Data Steward",
     "description": "Sales carry revenue"},
    {"id": "DQ-009", "table": "daily_sales", "field": "units_sold", "expectation": "below_200",
     "threshold": 0.999, "severity": "medium", "owner": "Store Operations",
     "description": "Daily units stay in a plausible range"},
    {"id": "DQ-010", "table": "inventory_snapshots", "field": "on_hand_units", "expectation": "non_negative",
     "threshold": 0.999, "severity": "critical", "owner": "Inventory Data Steward",
     "description": "Stock on hand is not negative"},
    {"id": "DQ-011", "table": "skus", "field": "unit_price", "expectation": "between_0.5_and_500",
     "threshold": 1.00, "severity": "medium", "owner": "Pricing Data Steward",
     "description": "Shelf prices stay in the retail band"},
]

RULE_COLUMNS = "id string, table string, field string, expectation string, threshold double, severity string, " \
    "owner string, description string"


class QualityGateError(RuntimeError):
    """A critical rule failed; publication must not go on."""


def load_rules(path: str, spark: SparkSession | None = None) -> list[dict]:
    """Rule library from a YAML (or JSON) file with a top-level ``rules`` list.

    With ``spark`` the file may lie in any store that Spark reads, otherwise on the driver's disk.
    """
    import yaml

    if spark is not None:
        text = spark.read.text(path, wholetext=True).first()[0]
        return yaml.safe_load(text)["rules"]
    with open(path, encoding="utf-8") as source:
        return yaml.safe_load(source)["rules"]


def save_rules(spark: SparkSession, rules: list[dict], path: str) -> None:
    """Write a rule library for :func:`load_rules`, as one JSON document."""
    import json

    spark.createDataFrame([(json.dumps({"rules": rules}),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def row_condition(rule: Mapping) -> Column | None:
    """Pass condition of a rule that looks at one row; None for rules about the whole column."""
    value, what = F.col(rule["field"]), rule["expectation"]
    if what == "unique_and_not_null" or what.startswith("referential_"):
        return None
    if what == "not_null":
        return value.isNotNull()
    if what == "non_negative":
        return value.isNull() | (value >= 0)
    if what.startswith("between_"):
        low, high = what.removeprefix("between_").split("_and_")
        return value.isNull() | value.between(float(low), float(high))
    if what.startswith("below_"):
        return value.isNull() | (value < float(what.removeprefix("below_").split("_")[0]))
    return F.lit(True)


def _row_rule_counts(table: DataFrame, rules: list[Mapping]) -> DataFrame:
    """All row rules of one table in a single pass."""
    counts = table.agg(
        F.count("*").alias("n"), *[count_true(row_condition(r)).alias(f"ok_{i}") for i, r in enumerate(rules)]
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(r["id"]).alias("id"), F.col("n").alias("rows_checked"), F.col(f"ok_{i}").alias("rows_passed")
            )
            for i, r in enumerate(rules)
        ]
    )
    return counts.select(F.inline(lines))


def _column_rule_counts(rule: Mapping, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Uniqueness and references, judged per distinct value: a value with many rows is counted before it moves."""
    values = tables[rule["table"]].groupBy(F.col(rule["field"]).alias("v")).agg(F.count("*").alias("c"))
    if rule["expectation"] == "unique_and_not_null":
        passed = F.when(F.col("v").isNotNull() & (F.col("c") == 1), F.col("c"))
    else:
        parent = rule["reference"]
        known = (
            tables[parent["table"]]
            .select(F.col(parent["field"]).alias("v"))
            .where(F.col("v").isNotNull())
            .distinct()
            .withColumn("known", F.lit(True))
        )
        values = values.join(known, "v", "left")
        passed = F.when(F.col("known"), F.col("c"))
    return values.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("rows_checked"), F.coalesce(F.sum(passed), F.lit(0)).alias("rows_passed")
    ).select(F.lit(rule["id"]).alias("id"), "rows_checked", "rows_passed")


def run_quality_rules(spark: SparkSession, tables: Mapping[str, DataFrame], rules: list[dict] = RULES) -> DataFrame:
    """One result row per rule: pass rate, rows checked and failed, and whether the rate reaches the threshold.

    A rule on a missing table or column fails with no rows checked; an empty table has no rate and fails.
    """
    usable, missing = [], []
    for rule in rules:
        table = tables.get(rule["table"])
        (usable if table is not None and rule["field"] in table.columns else missing).append(rule)

    parts: list[DataFrame] = []
    for name in dict.fromkeys(r["table"] for r in usable):
        row_rules = [r for r in usable if r["table"] == name and row_condition(r) is not None]
        if row_rules:
            parts.append(_row_rule_counts(tables[name], row_rules))
    parts += [_column_rule_counts(r, tables) for r in usable if row_condition(r) is None]
    if missing:
        parts.append(
            spark.createDataFrame(
                [(r["id"], 0, None) for r in missing], "id string, rows_checked bigint, rows_passed bigint"
            )
        )
    counts = reduce(DataFrame.unionByName, parts)

    library = spark.createDataFrame(
        [
            (
                r["id"], r["table"], r["field"], r["expectation"], float(r.get("threshold", 1.0)),
                r.get("severity"), r.get("owner"), r.get("description"),
            )
            for r in rules
        ],
        RULE_COLUMNS,
    )
    rate = safe_divide("rows_passed", "rows_checked")
    return (
        library.join(counts, "id")
        .select(
            *library.columns,
            rounded(rate, 4).alias("pass_rate"),
            "rows_checked",
            (F.col("rows_checked") - F.col("rows_passed")).alias("rows_failed"),
            F.coalesce(rate >= F.col("threshold"), F.lit(False)).alias("passed"),
        )
        .orderBy("id")
    )


def critical_failures(results: DataFrame) -> DataFrame:
    """The critical rules that failed."""
    return results.where((F.col("severity") == "critical") & ~F.col("passed"))


def quality_gate(results: DataFrame) -> None:
    """Stop when a critical rule failed. Only rule ids reach the driver."""
    failed = [r["id"] for r in critical_failures(results).select("id").collect()]
    if failed:
        raise QualityGateError(f"critical data-quality rules failed: {', '.join(sorted(failed))}")


def quality_by_owner(results: DataFrame) -> DataFrame:
    return results.groupBy("owner").agg(
        F.count("*").alias("rules"),
        F.count_if(~F.col("passed")).alias("rules_failing"),
        rounded(F.avg("pass_rate"), 4).alias("avg_pass_rate"),
    )


def quality_status(results: DataFrame) -> DataFrame:
    """Mean pass rate over the rules and its band."""
    mean = F.avg("pass_rate")
    return results.agg(
        rounded(mean, 4).alias("dq_pass_rate"),
        F.count_if(~F.col("passed")).alias("dq_rules_failing"),
        pass_rate_status(mean).alias("dq_status"),
    )


# --- master data ------------------------------------------------------------------------------------------------


def _repeats(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of each key value; NULL counts as one value."""
    return df.groupBy(key).agg((F.count("*") - 1).alias("extra")).agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("n"))


def orphans(rows: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return rows.join(parent.select(key), key, "left_anti")


def _orphan_count(rows: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    per_value = rows.groupBy(key).agg(F.count("*").alias("c"))
    return orphans(per_value, parent, key).agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"))


def master_data_checks(
    products: DataFrame,
    skus: DataFrame,
    stores: DataFrame,
    warehouses: DataFrame,
    suppliers: DataFrame,
    orders: DataFrame,
) -> DataFrame:
    """Two uniqueness and three reference checks with a readable detail."""
    product, location, supplier = "Product master", "Location master", "Supplier master"
    unique = F.when(F.col("n") == 0, "no duplicates").otherwise("duplicates found")
    checks = [
        ("product_id uniqueness", product, _repeats(products, "product_id"), F.format_string("%d duplicates", "n")),
        (
            "sku references known product_id",
            product,
            _orphan_count(skus, products, "product_id"),
            F.format_string("%d orphaned SKUs", "n"),
        ),
        (
            "store references known warehouse_id",
            location,
            _orphan_count(stores, warehouses, "warehouse_id"),
            F.format_string("%d orphaned stores", "n"),
        ),
        ("supplier_id uniqueness", supplier, _repeats(suppliers, "supplier_id"), unique),
        (
            "purchase order references known sku_id",
            supplier,
            _orphan_count(orders, skus, "sku_id"),
            F.format_string("%d purchase orders reference an unknown SKU", "n"),
        ),
    ]
    rows = [
        found.select(
            F.lit(name).alias("check"), F.lit(domain).alias("domain"), (F.col("n") == 0).alias("passed"),
            detail.alias("detail"),
        )
        for name, domain, found, detail in checks
    ]
    return reduce(DataFrame.unionByName, rows)


# --- overrides --------------------------------------------------------------------------------------------------


def override_reasons(decisions: DataFrame) -> DataFrame:
    return decisions.where("override_flag").groupBy("override_reason").agg(F.count("*").alias("decisions"))


def override_summary(decisions: DataFrame) -> DataFrame:
    """Totals and rates in one pass; the reasons ride along as a map with one entry per reason."""
    reason = F.when(F.col("override_flag"), F.col("override_reason"))
    by_reason = decisions.groupBy(reason.alias("reason")).agg(
        F.count("*").alias("total"), count_true("override_flag").alias("overrides")
    )
    share = safe_divide("override_count", "total_decisions")
    entries = F.collect_list(F.when(F.col("reason").isNotNull(), F.struct("reason", "overrides")))
    return (
        by_reason.agg(
            F.coalesce(F.sum("total"), F.lit(0)).alias("total_decisions"),
            F.coalesce(F.sum("overrides"), F.lit(0)).alias("override_count"),
            F.map_from_entries(F.array_sort(entries)).alias("override_reasons"),
        )
        .withColumn("override_rate", rounded(share, 4))
        .withColumn("auto_approved_rate", rounded(1 - share, 4))
        .select("total_decisions", "override_count", "override_rate", "auto_approved_rate", "override_reasons")
    )


# --- failing-rows form ------------------------------------------------------------------------------------------


def rows_with_null(df: DataFrame, column: str) -> DataFrame:
    """Rows that break a not-null test."""
    return df.where(F.col(column).isNull())


def rows_below_zero(df: DataFrame, column: str) -> DataFrame:
    """Rows that break a non-negative test."""
    return df.where(F.col(column) < 0)


def staging_tests(staged_sales: DataFrame, staged_inventory: DataFrame) -> DataFrame:
    """Failures of the staging tests, one row per test."""

    def counted(df: DataFrame, name: str, tests: dict[str, Column]) -> DataFrame:
        failures = df.agg(*[count_true(c).alias(t) for t, c in tests.items()])
        lines = F.array(
            *[F.struct(F.lit(name).alias("model"), F.lit(t).alias("test"), F.col(t).alias("failures")) for t in tests]
        )
        return failures.select(F.inline(lines))

    def missing(*columns: str) -> dict[str, Column]:
        return {f"not_null_{c}": F.col(c).isNull() for c in columns}

    sales_tests = {
        **missing("store_id", "sku_id", "units_sold"),
        "non_negative_units_sold": F.col("units_sold") < 0,
    }
    return counted(staged_sales, "stg_daily_sales", sales_tests).unionByName(
        counted(staged_inventory, "stg_inventory_snapshots", missing("location_id", "sku_id"))
    )
