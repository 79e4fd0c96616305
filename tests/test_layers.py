import pytest
from helpers import day, one, rows
from stockloom.operators import gold, inventory, marts, panel, silver
from stockloom.plans.warehouse import reconcile_layers
from stockloom.sources.schemas import RAW_SCHEMAS
from stockloom.sources.tables import read_layer, write_layer

SALES = RAW_SCHEMAS["daily_sales"]


def skus(spark):
    return spark.createDataFrame([("A", "P1", 2.0), ("B", "P2", 3.0)], "sku_id string, product_id string, unit_price double")


def test_sales_are_repaired_deduplicated_and_flagged(spark):
    d = day("2026-01-01")
    raw = spark.createDataFrame(
        [
            (d, "S1", "A", 5, None, True),  # revenue from the price
            (d, "S1", "A", 5, 10.0, True),  # equal after the repair: one row stays
            (d, "S1", "B", 1, 3.0, False),
            (d, "S1", "B", 1, 3.0, False),  # loaded twice
            (d, "S2", "B", 200, 600.0, False),  # outlier bound is inclusive
            (d, "S2", "GONE", 1, 1.0, False),  # unknown SKU
        ],
        SALES,
    )
    got = rows(silver.clean_sales(raw, skus(spark)), "store_id", "sku_id")
    assert [(r["store_id"], r["sku_id"], r["revenue"], r["is_volume_outlier"]) for r in got] == [
        ("S1", "A", 10.0, False),
        ("S1", "B", 3.0, False),
        ("S2", "B", 600.0, True),
    ]


def test_negative_and_missing_stock_become_zero(spark):
    raw = spark.createDataFrame(
        [(day("2026-01-01"), "Store", "S1", s, v, 0.0, 0.0, 1.0) for s, v in (("A", -3.0), ("B", None), ("C", 4.0))],
        RAW_SCHEMAS["inventory_snapshots"],
    )
    got = rows(silver.clean_inventory(raw), "sku_id")
    assert [(r["on_hand_units"], r["had_negative_on_hand_defect"]) for r in got] == [(0.0, True), (0.0, None), (4.0, False)]


def test_orphans_are_dropped_without_multiplying_rows(spark):
    parents = spark.createDataFrame([("P1",), ("P1",)], "product_id string")
    assert [r["sku_id"] for r in rows(silver.drop_orphans(skus(spark), parents, "product_id"))] == ["A"]


def test_imputation_uses_the_mean_of_the_group(spark):
    raw = spark.createDataFrame(
        [("X", 1.0), ("X", 3.0), ("X", None), ("Y", None), (None, 8.0), (None, None)], "region string, t double"
    )
    got = rows(silver.impute_by_group_mean(raw, "region", ["t"]), "region", "t")
    assert [(r["region"], r["t"]) for r in got] == [("X", 1.0), ("X", 2.0), ("X", 3.0), ("Y", None), (None, 8.0), (None, 8.0)]


def test_calendar_covers_every_day(spark):
    sales = spark.createDataFrame([(day("2026-07-31"),), (day("2026-08-03"),)], "date date")
    got = rows(gold.dim_date(sales), "date_key")
    assert [(str(r["date_key"]), r["day_of_week"], r["is_weekend"]) for r in got] == [
        ("2026-07-31", 5, False),
        ("2026-08-01", 6, True),
        ("2026-08-02", 0, True),
        ("2026-08-03", 1, False),
    ]
    assert got[0]["iso_week"] == 31


def test_supplier_mart_and_scorecard(spark):
    orders = spark.createDataFrame(
        [
            ("S1", day("2026-01-01"), day("2026-01-05"), day("2026-01-06"), 10.0, 9.0),
            ("S1", day("2026-01-01"), day("2026-01-05"), day("2026-01-05"), 0.0, 5.0),
            ("S2", day("2026-01-01"), day("2026-01-05"), day("2026-01-03"), 4.0, 4.0),
        ],
        "supplier_id string, order_date date, expected_delivery_date date, actual_delivery_date date, "
        "quantity_ordered double, quantity_received double",
    )
    for c in ("po_id", "sku_id", "warehouse_id", "status"):
        orders = orders.selectExpr("*", f"'x' as {c}")
    orders = orders.selectExpr("*", "1D as unit_cost")
    suppliers = spark.createDataFrame(
        [("S1", "One", 0.9, "N"), ("S2", "Two", 0.8, "S"), ("S3", "Idle", 0.7, "S")],
        "supplier_id string, supplier_name string, reliability_score double, region_of_origin string",
    )
    mart = gold.supplier_performance(gold.fact_purchase_orders(orders), suppliers)
    got = rows(gold.supplier_scorecard(mart))
    assert [(r["supplier_id"], r["late_rate_pct"], r["avg_fill_rate_pct"], r["delivery_status"]) for r in got] == [
        ("S1", 50.0, 90.0, "Critical"),
        ("S2", 0.0, 100.0, "Healthy"),
    ]
    assert [r["supplier_id"] for r in rows(gold.worst_suppliers(mart, 1))] == ["S1"]


def test_staging_casts_and_filters(spark):
    raw = spark.createDataFrame(
        [("2026-01-01", "S", "A", "5", "1.239", "true"), ("bad", "S", "A", "-1", "x", "false"), ("2026-01-02", "S", "A", "0", None, "true")],
        "date string, store_id string, sku_id string, units_sold string, revenue string, promo_flag string",
    )
    got = rows(marts.staged_sales(raw), "sale_date")
    assert [(str(r["sale_date"]), r["units_sold"], str(r["revenue"])) for r in got] == [("2026-01-01", 5, "1.24"), ("2026-01-02", 0, "None")]
    stores = spark.createDataFrame([("S", "N", "Metro")], "store_id string, region string, store_format string")
    sku = spark.createDataFrame([("A", "C", "D")], "sku_id string, category string, subcategory string")
    per_unit = [r["revenue_per_unit"] for r in rows(marts.enriched_sales(marts.staged_sales(raw), sku, stores), "sale_date")]
    assert per_unit == [0.248, None]


def test_inventory_health_windows_and_missing_stockouts(spark):
    inv = spark.createDataFrame(
        [(day("2026-02-01"), "Store", "A", 8.0), (day("2026-01-02"), "Store", "A", 4.0), (day("2026-01-01"), "Store", "A", 99.0),
         (day("2026-02-01"), "Warehouse", "A", 50.0), (day("2026-02-01"), "Store", "B", 1.0)],
        "date_key date, location_type string, sku_id string, days_of_supply double",
    )
    out = spark.createDataFrame(
        [(day("2026-03-01"), "A", True, 3), (day("2026-01-30"), "A", True, 5), (day("2026-01-29"), "A", True, 9), (day("2026-03-01"), "A", False, 7)],
        "date_key date, sku_id string, stockout_flag boolean, lost_sales_units_estimate bigint",
    )
    products = spark.createDataFrame([("A", "Frozen"), ("B", "Snacks")], "sku_id string, category string")
    got = rows(marts.inventory_health(inv, out, products))
    assert [tuple(r.values()) for r in got] == [("Frozen", 6.0, 50.0, 2, 8), ("Snacks", 1.0, 0.0, 0, 0)]


def test_layers_reconcile_and_report_growth(spark):
    d = day("2026-01-01")
    raw = {name: spark.createDataFrame([], ddl) for name, ddl in RAW_SCHEMAS.items()}
    raw["skus"] = spark.createDataFrame([("A", "P", "C", "D", "1", "EA", "9", 1.0, 2.0, 1, False)], RAW_SCHEMAS["skus"])
    raw["products"] = spark.createDataFrame([("P", "C", "D", "B", 1.0, 2.0, 9, False, d, False)], RAW_SCHEMAS["products"])
    raw["daily_sales"] = spark.createDataFrame([(d, "S", "A", 1, 2.0, False), (d, "S", "A", 1, 2.0, False)], SALES)
    cleaned = silver.build_silver(raw)
    star = gold.build_gold(cleaned)
    checks = {r["check"]: r for r in rows(reconcile_layers(raw, cleaned, star))}
    assert all(r["passed"] for r in checks.values())
    assert checks["silver daily_sales within bronze"]["left_value"] == 1
    assert checks["silver daily_sales within bronze"]["right_value"] == 2
    grown = {**cleaned, "skus": cleaned["skus"].union(cleaned["skus"])}
    failed = [r["check"] for r in rows(reconcile_layers(raw, grown, star)) if not r["passed"]]
    assert failed == ["silver skus within bronze"]


def test_empty_sales_give_an_empty_calendar(spark):
    assert rows(gold.dim_date(spark.createDataFrame([], "date date"))) == []


def test_category_mart_counts_store_rows_only(spark):
    inv = spark.createDataFrame(
        [("Store", "A", 7.0), ("Store", "A", 5.0), ("Warehouse", "A", 9.0), ("Store", "GONE", 9.0)],
        "location_type string, sku_id string, days_of_supply double",
    )
    got = one(marts.category_stock_mart(inv, spark.createDataFrame([("A", "C")], "sku_id string, category string")))
    assert got == {"category": "C", "snapshot_rows": 2, "avg_days_of_supply": 6.0, "excess_stock_rate": 0.5}


@pytest.mark.parametrize("what", ["inventory_health", "demand_statistics", "latest_weeks"])
def test_newest_days_skip_month_folders(spark, tmp_path, what):
    days = spark.sql("select explode(sequence(date'2023-01-01', date'2024-03-20', interval 1 day)) as date_key")
    fact = days.selectExpr("date_key", "'S' as store_id", "'A' as sku_id", "'Store' as location_type", "1L as units_sold", "2D as days_of_supply", "true as stockout_flag", "3L as lost_sales_units_estimate", "9D as lost_sales_revenue_estimate")
    write_layer({"fact_daily_sales": fact, "fact_inventory": fact, "fact_stockouts": fact}, str(tmp_path), "gold")
    read = read_layer(spark, str(tmp_path), "gold", ["fact_daily_sales", "fact_inventory", "fact_stockouts"])
    products = spark.createDataFrame([("A", "X")], "sku_id string, category string")
    sales = read["fact_daily_sales"]
    run = {
        "inventory_health": lambda sales, stock, outs: marts.inventory_health(stock, outs, products),
        "demand_statistics": lambda sales, stock, outs: inventory.demand_statistics(sales, date="date_key"),
        "latest_weeks": lambda sales, stock, outs: panel.latest_weeks(sales, date="date_key").drop("load_month"),
    }[what]
    found = run(sales, read["fact_inventory"], read["fact_stockouts"])
    whole = run(fact, fact, fact)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, whole.select(*found.columns).collect()))
    plan = found._jdf.queryExecution().sparkPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("load_month" in line.partition("PartitionFilters: [")[2].partition("]")[0] for line in scans)


def test_late_rows_replace_their_months_only(spark, tmp_path):
    import datetime
    import os

    from stockloom.sources.tables import merge_months, read_layer, replace_months, write_layer

    schema = "po_id string, order_date date, quantity_ordered long"

    def rows(*given):
        return spark.createDataFrame([(k, datetime.date.fromisoformat(d) if d else None, q) for k, d, q in given], schema)

    def state():
        back = read_layer(spark, str(tmp_path), "gold", ["fact_purchase_orders"])["fact_purchase_orders"]
        return sorted(((r.po_id, str(r.order_date), r.quantity_ordered) for r in back.collect()), key=str)

    def files():
        base = tmp_path / "gold" / "fact_purchase_orders"
        return {p.name: sorted(f for f in os.listdir(p) if f.endswith(".parquet")) for p in base.iterdir() if p.is_dir()}

    first = rows(("a", "2024-01-05", 1), ("b", "2024-01-06", 2), ("c", "2024-02-01", 3), ("d", "2024-03-01", 4), (None, "2024-03-02", 5), ("n", None, 6))
    write_layer({"fact_purchase_orders": first}, str(tmp_path), "gold")
    before = files()
    # a correction in January, c moves to April and leaves February empty; the null key replaces nothing
    late = rows(("b", "2024-01-07", 20), ("c", "2024-04-01", 30), (None, "2024-04-02", 50))
    merge_months(late, str(tmp_path), "gold", "fact_purchase_orders", ["po_id"])
    after = files()
    want = [("a", "2024-01-05", 1), ("b", "2024-01-07", 20), ("c", "2024-04-01", 30), ("d", "2024-03-01", 4), (None, "2024-03-02", 5), (None, "2024-04-02", 50), ("n", "None", 6)]
    assert state() == sorted(want, key=str)
    changed = {m for m in before.keys() | after.keys() if before.get(m) != after.get(m)}
    assert changed == {"load_month=2024-01-01", "load_month=2024-02-01", "load_month=2024-04-01"}
    merge_months(late.where("po_id is not null"), str(tmp_path), "gold", "fact_purchase_orders", ["po_id"])
    assert state() == sorted(want, key=str)
    merge_months(rows(("n", "2024-03-03", 7)), str(tmp_path), "gold", "fact_purchase_orders", ["po_id"])
    assert ("n", "2024-03-03", 7) in state() and "load_month=__HIVE_DEFAULT_PARTITION__" not in files()
    merge_months(rows(), str(tmp_path), "gold", "fact_purchase_orders", ["po_id"])
    assert len(state()) == 7
    replace_months(rows(("e", "2024-01-01", 9)), str(tmp_path), "gold", "fact_purchase_orders")
    assert [x for x in state() if x[1].startswith("2024-01")] == [("e", "2024-01-01", 9)] and len(state()) == 6


@pytest.mark.parametrize("most", [1, 3, 10**9])
def test_months_are_merged_in_steps(spark, tmp_path, monkeypatch, most):
    import datetime
    import random

    from stockloom.sources import tables

    schema, seen, durable = "po_id string, order_date date, quantity_ordered long", [], tables.durable

    def frame(given):
        return spark.createDataFrame(given, schema)

    def keep(df, name):
        out = durable(df, name)
        if name.startswith("merged"):
            seen.append(out.count())
        return out

    monkeypatch.setattr(tables, "MERGED_ROWS", most, raising=False)
    monkeypatch.setattr(tables, "durable", keep)
    rnd = random.Random(2)

    def some_day():
        return None if rnd.random() < 0.1 else datetime.date(2024, rnd.randint(1, 5), rnd.randint(1, 28))

    first = [(f"k{i}" if i % 9 else None, some_day(), i) for i in range(14)]
    late = [(f"k{i}" if i % 9 else None, some_day(), 100 + i) for i in (2, 3, 3, 5, 9, 30, 31)]
    write_layer({"fact_purchase_orders": frame(first)}, str(tmp_path), "gold")
    tables.merge_months(frame(late), str(tmp_path), "gold", "fact_purchase_orders", ["po_id"])
    gone = {k for k, _, _ in late if k}
    back = read_layer(spark, str(tmp_path), "gold", ["fact_purchase_orders"])["fact_purchase_orders"]
    want = [r for r in first if r[0] not in gone] + late
    assert sorted(map(str, ((r.po_id, r.order_date, r.quantity_ordered) for r in back.collect()))) == sorted(map(str, want))
    assert all((r.load_month is None) == (r.order_date is None) and (r.load_month is None or r.load_month == r.order_date.replace(day=1)) for r in back.collect())
    assert len(seen) == 1 if most > 100 else len(seen) > 2
