"""One function per registered query: (spark, folder) to DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.star import Star, tidy
from stockloom.functions import stocking
from stockloom.functions.banding import status_colour
from stockloom.functions.columns import month_start
from stockloom.operators import (
    anomalies,
    dashboards,
    delivery_risk,
    forecasting,
    gold,
    inventory,
    kpis,
    marts,
    measures,
    monitoring,
    panel,
    promotions,
    quality,
    reconciliation,
    silver,
)
from stockloom.operators.boosting import BoostedTrees
from stockloom.plans import warehouse
from stockloom.sources.durable import durable, shared_folder
from stockloom.sources.tables import merge_months, read_layer, read_raw, read_service_levels, row_counts, write_layer, write_raw

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[Star], DataFrame]) -> Callable[[Star], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return tidy(build(Star(spark, folder)))

    run.__name__ = build.__name__
    run.__doc__ = build.__doc__
    QUERIES[build.__name__] = run
    return build


def _fresh(s: Star, name: str) -> str:
    import uuid

    return f"{shared_folder(s.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# --- sources and layers -----------------------------------------------------------------------------------------


@query
def raw_extract_round_trip(s):
    """Raw CSV extracts written and read back with declared schemas, one line per table and store."""
    folder = _fresh(s, "extract")
    names = ["daily_sales", "stock_outs", "returns"]
    write_raw({n: s.raw(n) for n in names}, folder)
    back = read_raw(s.spark, folder, names)
    units = {"daily_sales": "units_sold", "stock_outs": "lost_sales_units_estimate", "returns": "quantity"}
    parts = [
        back[n].groupBy("store_id").agg(F.count("*").alias("row_count"), F.sum(units[n]).alias("units"))
        .select(F.lit(n).alias("table_name"), "store_id", "row_count", "units")
        for n in names
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def gold_layer_by_month(s):
    """Gold facts written with month partitions and read back."""
    folder = _fresh(s, "layer")
    write_layer({"fact_daily_sales": s.fact_sales, "fact_purchase_orders": s.fact_orders}, folder, "gold")
    back = read_layer(s.spark, folder, "gold", ["fact_daily_sales", "fact_purchase_orders"])
    parts = [
        df.groupBy("load_month").agg(F.count("*").alias("row_count")).select(
            F.lit(n).alias("table_name"), "load_month", "row_count"
        )
        for n, df in back.items()
    ]
    return parts[0].unionByName(parts[1])


@query
def gold_layer_late_rows(s):
    """Purchase orders loaded without a tenth of them, and with old versions of some in other months; then these merged in."""
    folder = _fresh(s, "layer")
    orders = durable(s.fact_orders, "orders")
    part = F.pmod(F.xxhash64("po_id"), F.lit(20))
    old = orders.where(part == 0).withColumn("order_date", F.date_sub("order_date", 40).cast(orders.schema["order_date"].dataType))
    first = orders.where(part > 1).unionByName(old.withColumn("quantity_received", F.lit(0).cast(orders.schema["quantity_received"].dataType)))
    write_layer({"fact_purchase_orders": first}, folder, "gold")
    merge_months(orders.where(part <= 1), folder, "gold", "fact_purchase_orders", ["po_id"])
    back = read_layer(s.spark, folder, "gold", ["fact_purchase_orders"])["fact_purchase_orders"]
    return back.groupBy("load_month").agg(
        F.count("*").alias("row_count"),
        F.sum(F.col("quantity_ordered").cast("double")).alias("ordered"),
        F.sum(F.col("quantity_received").cast("double")).alias("received"),
    )


@query
def bronze_row_counts(s):
    return row_counts(s.all_raw(), "bronze")


@query
def layer_reconciliation(s):
    s.store("daily_sales", "purchase_orders")
    raw = s.all_raw()
    layer = silver.build_silver(raw)
    return warehouse.reconcile_layers(raw, layer, gold.build_gold(layer))


@query
def silver_products(s):
    return silver.clean_products(s.raw("products"))


@query
def silver_skus(s):
    return s.skus


@query
def silver_stores(s):
    return silver.drop_orphans(s.raw("stores"), s.raw("warehouses"), "warehouse_id")


@query
def silver_daily_sales(s):
    return s.sales


@query
def silver_inventory_snapshots(s):
    return s.snapshots


@query
def silver_purchase_orders(s):
    return s.orders


@query
def silver_weather(s):
    return s.weather


@query
def silver_pass_through(s):
    """Tables copied unchanged: row count and one checksum each."""
    sums = {
        "warehouses": "capacity_units",
        "suppliers": "reliability_score",
        "lead_times": "sample_size",
        "promotions": "planned_uplift_pct",
        "prices": "list_price",
        "markdowns": "markdown_pct",
        "holidays": None,
        "returns": "quantity",
        "stock_outs": "lost_sales_units_estimate",
        "replenishment_decisions": "approved_qty",
    }
    copied = silver.build_silver(s.all_raw())
    out = None
    for name, column in sums.items():
        total = F.sum(F.col(column).cast("double")) if column else F.count("*").cast("double")
        one = copied[name].agg(F.count("*").alias("row_count"), total.alias("total"))
        one = one.select(F.lit(name).alias("table_name"), "row_count", "total")
        out = one if out is None else out.unionByName(one)
    return out


@query
def gold_dim_date(s):
    return s.dim_date


@query
def gold_dim_product(s):
    return s.dim_product


@query
def gold_dim_store(s):
    return s.dim_store


@query
def gold_fact_daily_sales(s):
    return s.fact_sales


@query
def gold_fact_inventory(s):
    return s.fact_inventory


@query
def gold_fact_purchase_orders(s):
    return s.fact_orders


@query
def gold_fact_stockouts(s):
    return s.fact_stockouts


@query
def gold_fact_replenishment_decisions(s):
    return s.fact_decisions


@query
def supplier_performance(s):
    return s.performance


@query
def supplier_scorecard(s):
    return gold.supplier_scorecard(s.performance)


@query
def worst_suppliers(s):
    return gold.worst_suppliers(s.performance).select("supplier_id", "late_rate", "purchase_orders")


# --- marts ------------------------------------------------------------------------------------------------------


@query
def staged_inventory(s):
    return marts.staged_inventory(s.raw("inventory_snapshots"))


@query
def enriched_sales(s):
    staged = marts.staged_sales(s.raw("daily_sales"))
    # The staged revenue is a two-decimal amount; cents of a distributed sum may differ in the last place.
    out = marts.enriched_sales(staged, s.raw("skus"), s.raw("stores"))
    return out.groupBy("category", "store_id", "store_format", "region", "promo_flag").agg(
        F.count("*").alias("row_count"),
        F.sum("units_sold").alias("units_sold"),
        F.count("revenue").alias("rows_with_revenue"),
        F.round(F.sum("revenue").cast("double"), 0).alias("revenue"),
        F.round(F.avg("revenue_per_unit"), 2).alias("revenue_per_unit"),
    )


@query
def category_stock_mart(s):
    return marts.category_stock_mart(marts.staged_inventory(s.raw("inventory_snapshots")), s.raw("skus"))


@query
def inventory_health(s):
    return marts.inventory_health(s.fact_inventory, s.fact_stockouts, s.dim_product)


@query
def staging_tests(s):
    return quality.staging_tests(
        marts.staged_sales(s.raw("daily_sales")), marts.staged_inventory(s.raw("inventory_snapshots"))
    )


# --- panel and forecasts ----------------------------------------------------------------------------------------


@query
def weekly_demand_panel(s):
    return s.panel


@query
def full_weeks_panel(s):
    """Panel without the partial first and last week."""
    s.store("daily_sales")
    full = panel.weekly_demand_panel(
        s.raw("daily_sales"), s.raw("skus"), s.raw("stores"), s.raw("holidays"), s.raw("weather"),
        drop_partial_weeks=True,
    )
    return full.groupBy("week").agg(F.count("*").alias("series"), F.sum("units_sold").alias("units_sold"))


@query
def time_split(s):
    train, test = s.split

    def described(df: DataFrame, name: str) -> DataFrame:
        return df.agg(
            F.count("*").alias("row_count"),
            F.min("week").alias("first_week"),
            F.max("week").alias("last_week"),
            F.sum("units_sold").alias("units_sold"),
        ).select(F.lit(name).alias("split"), "*")

    return described(train, "train").unionByName(described(test, "test"))


@query
def moving_average_forecast(s):
    return s.baseline.select("store_id", "sku_id", "week", "units_sold", "forecast_units")


@query
def moving_average_accuracy(s):
    return forecasting.forecast_accuracy(s.baseline)


@query
def series_mean_feature(s):
    _, test = forecasting.add_series_mean(*s.split)
    return test.select("store_id", "sku_id", "week", "combo_mean_hist")


@query
def smoothing_forecast(s):
    return forecasting.forecast_exponential_smoothing(s.panel)


@query
def smoothing_accuracy(s):
    return forecasting.forecast_accuracy(forecasting.forecast_exponential_smoothing(s.panel), "actual_units")


@query
def boosted_tree_forecast(s):
    train, test = s.split
    _, scored = forecasting.forecast_boosted_trees(train, test)
    return scored.select("store_id", "sku_id", "week", "units_sold", "forecast_units")


@query
def saved_demand_model_scores(s):
    """The demand model saved, loaded by another session with a check of its features, and scored by both, by week."""
    train, test = forecasting.add_series_mean(*s.split)
    model, path = forecasting.train_demand_model(train), _fresh(s, "demand-model")
    model.save(s.spark, path)
    back = BoostedTrees.load(s.spark.newSession(), path, forecasting.FEATURES)
    both = back.score(model.score(test, "before"), "after")
    alike = F.count_if(F.col("before") == F.col("after"))
    return both.groupBy("week").agg(F.count("*").alias("row_count"), alike.alias("rows_alike"))


@query
def forecast_comparison(s):
    return s.comparison.select(
        "store_id", "sku_id", "week", "units_sold", "forecast_units_advanced", "forecast_units_baseline"
    )


@query
def relative_improvement(s):
    return forecasting.relative_improvement(s.comparison)


@query
def reconcile_baseline(s):
    return reconciliation.accuracy_by_level(s.baseline, "Baseline (4-week moving average)")


@query
def reconcile_top_down(s):
    return reconciliation.reconcile_top_down(s.sku_mean_forecast, s.baseline)


@query
def reconcile_top_down_every_pair(s):
    return reconciliation.reconcile_top_down(s.sku_mean_forecast, s.baseline, every_pair=True)


@query
def reconcile_top_down_training_share(s):
    return reconciliation.reconcile_top_down(s.sku_mean_forecast, s.baseline, share_rows=s.split[0])


@query
def reconcile_all_methods(s):
    """Boosted trees bottom-up, smoothing top-down and the baseline, 11 rows."""
    train, test = s.split
    _, champion = forecasting.forecast_boosted_trees(train, test)
    smoothing = forecasting.forecast_exponential_smoothing(s.saved_panel)
    return reconciliation.reconcile(
        durable(champion, "champion"), smoothing, forecasting.forecast_moving_average(test)
    )


# --- inventory --------------------------------------------------------------------------------------------------


@query
def lead_time_statistics(s):
    return s.raw("lead_times")


@query
def demand_statistics(s):
    return s.demand_stats


@query
def reorder_recommendations(s):
    return s.recommendations


@query
def reorder_recommendations_from_level_file(s):
    """Service levels by category written as a CSV seed, read back with its schema and used for the recommendations."""
    folder = _fresh(s, "service-levels")
    high = F.col("category").isin("PROMO", "SMALL")
    levels = s.raw("skus").select("category").distinct().withColumn("target_service_level", F.when(high, 0.97).otherwise(0.90))
    levels.withColumn("rationale", F.lit("stated, in short")).write.option("header", True).csv(folder)
    return inventory.reorder_recommendations(
        s.demand_stats, s.raw("lead_times"), s.raw("skus"), holding_base="unit_cost",
        category_z=stocking.category_z(read_service_levels(s.spark, folder)),
    )


@query
def reorder_recommendations_by_category(s):
    """Service level by category and holding cost on the unit cost."""
    high = F.col("category").isin("PROMO", "SMALL")
    levels = s.raw("skus").select("category").distinct()
    z = stocking.category_z(levels.withColumn("target_service_level", F.when(high, 0.97).otherwise(0.90)))
    return inventory.reorder_recommendations(
        s.demand_stats, s.raw("lead_times"), s.raw("skus"), holding_base="unit_cost", category_z=z
    )


@query
def scenario_summary(s):
    return inventory.run_scenarios(s.recommendations)


@query
def scenario_shock(s):
    return inventory.apply_scenario(s.recommendations, 0.25, 0.30)


@query
def replenishment_requests(s):
    return inventory.replenishment_requests(s.raw("inventory_snapshots"), s.recommendations)


@query
def reorder_queue(s):
    return dashboards.reorder_queue(inventory.replenishment_requests(s.raw("inventory_snapshots"), s.recommendations))


@query
def warehouse_allocation(s):
    requests = inventory.replenishment_requests(s.raw("inventory_snapshots"), s.recommendations)
    requests = requests.join(s.raw("stores").select("store_id", "warehouse_id"), "store_id")
    stock = inventory.latest_snapshot(s.raw("inventory_snapshots").where(F.col("location_type") == "Warehouse"))
    available = stock.select(F.col("location_id").alias("warehouse_id"), "sku_id", "on_hand_units")
    return inventory.allocate_requests(requests, available)


@query
def days_of_supply(s):
    return inventory.with_days_of_supply(s.raw("inventory_snapshots"), s.demand_stats).select(
        "date", "location_id", "sku_id", "computed_days_of_supply"
    )


@query
def lost_sales(s):
    """Demand beyond 150 units a day counts as unmet."""
    sold = F.least(F.col("units_sold"), F.lit(150))
    demand = s.raw("daily_sales").select(
        "date", "store_id", "sku_id", F.col("units_sold").alias("demand_units"), sold.alias("units_sold")
    )
    return inventory.lost_sales(demand, s.raw("skus"))


# --- promotions -------------------------------------------------------------------------------------------------


@query
def promotion_uplift(s):
    return s.uplift


@query
def promotion_uplift_summary(s):
    return promotions.uplift_summary(s.uplift)


@query
def promoted_sales_flag(s):
    flagged = promotions.flag_promoted_sales(s.raw("daily_sales"), s.raw("promotions"))
    return flagged.select("date", "store_id", "sku_id", "units_sold", "on_promotion")


@query
def uplift_review_queue(s):
    return promotions.uplift_review_queue(s.uplift).select("promo_id", "uplift_pct", "planned_uplift_pct", "variance_pp")


# --- anomalies --------------------------------------------------------------------------------------------------


def _stated_anomalies(s: Star) -> DataFrame:
    features = anomalies.stock_features(s.raw("inventory_snapshots"))
    score = F.abs("dos_change") + F.abs("on_hand_units") / 100
    return anomalies.classify_anomalies(durable(features.withColumn("anomaly_score", score), "step-scores"))


@query
def stock_features(s):
    return anomalies.stock_features(s.raw("inventory_snapshots"))


@query
def anomalies_by_step(s):
    """Threshold and classes on a score plain SQL can state: the step in days of supply plus the stock level."""
    return _stated_anomalies(s)


@query
def isolation_forest_anomalies(s):
    return anomalies.detect_anomalies(s.raw("inventory_snapshots"))


@query
def anomaly_types(s):
    return dashboards.anomaly_types(_stated_anomalies(s))


# --- delivery risk ----------------------------------------------------------------------------------------------


def _risk(s: Star) -> delivery_risk.RiskResult:
    return delivery_risk.train_delivery_risk(s.raw("purchase_orders"), s.raw("suppliers"), s.raw("skus"))


@query
def order_risk_features(s):
    return delivery_risk.order_features(s.raw("purchase_orders"), s.raw("suppliers"), s.raw("skus")).select(
        "po_id", "supplier_id", "sku_id", "is_late", "quoted_lead_time_days", "order_month", "reliability_score",
        "region_of_origin", "category",
    )


@query
def delivery_risk_metrics(s):
    return _risk(s).metrics


@query
def delivery_risk_importance(s):
    return _risk(s).importance


@query
def supplier_delivery_risk(s):
    return _risk(s).supplier_risk


def _stated_risk(s: Star) -> DataFrame:
    """A score plain SQL can state: short quotes from unreliable suppliers."""
    features = delivery_risk.order_features(s.raw("purchase_orders"), s.raw("suppliers"), s.raw("skus"))
    return features.withColumn(
        "late_risk_score", (1 - F.col("reliability_score")) * 45 / F.col("quoted_lead_time_days")
    )


@query
def supplier_risk_rollup(s):
    return delivery_risk.supplier_risk(_stated_risk(s))


@query
def risk_review_queue(s):
    return delivery_risk.risk_review_queue(_stated_risk(s)).select("po_id", "supplier_id", "late_risk_score")


@query
def stated_risk_auc(s):
    """Area under the curve of the stated score over all orders."""
    return delivery_risk.holdout_auc(_stated_risk(s).withColumn("in_holdout", F.lit(True)))


@query
def stale_scenarios(s):
    """Promotion plans taken as scenarios run on the day of their start, older than 90 days on the last day of sales."""
    log = s.raw("promotions").select(F.col("promo_id").alias("scenario"), F.col("start_date").alias("run_date"))
    return monitoring.stale_scenarios(log, s.raw("daily_sales").agg(F.max("date")).scalar())


# --- quality ----------------------------------------------------------------------------------------------------


@query
def quality_rules(s):
    return s.rules.drop("description")


@query
def quality_rules_from_file(s):
    """The rule library written to the shared folder, read back and run."""
    path = _fresh(s, "rule-library")
    quality.save_rules(s.spark, quality.RULES, path)
    rules = quality.load_rules(path, s.spark)
    needed = {r["table"] for r in rules} | {r["reference"]["table"] for r in rules if "reference" in r}
    return quality.run_quality_rules(s.spark, {n: s.raw(n) for n in needed}, rules).drop("description")


@query
def critical_failures(s):
    """What stops the gate before gold is written."""
    return quality.critical_failures(s.rules).select("id", "pass_rate", "threshold", "rows_failed")


@query
def quality_by_owner(s):
    return quality.quality_by_owner(s.rules)


@query
def quality_status(s):
    return quality.quality_status(s.rules)


@query
def master_data_checks(s):
    return quality.master_data_checks(
        *[s.raw(n) for n in ("products", "skus", "stores", "warehouses", "suppliers", "purchase_orders")]
    )


@query
def override_summary(s):
    return quality.override_summary(s.raw("replenishment_decisions")).drop("override_reasons")


@query
def override_reasons(s):
    return quality.override_reasons(s.raw("replenishment_decisions"))


# --- monitoring -------------------------------------------------------------------------------------------------


@query
def forecast_performance_weekly(s):
    return monitoring.weekly_forecast_performance(s.baseline)


@query
def control_chart(s):
    return dashboards.control_chart(monitoring.weekly_forecast_performance(s.baseline))


@query
def retrain_weeks(s):
    return monitoring.retrain_weeks(monitoring.weekly_forecast_performance(s.baseline))


@query
def late_rate_shift(s):
    return monitoring.late_rate_shift(s.fact_orders, F.lit("1998-01-01").cast("date"))


@query
def category_fallback(s):
    return monitoring.fall_back_by_category(s.comparison).select(
        "store_id", "sku_id", "week", "category_status", "forecast_units"
    )


@query
def demand_drift(s):
    return monitoring.demand_drift(s.saved_panel)


@query
def supplier_delivery_status(s):
    return monitoring.supplier_delivery_status(s.raw("lead_times"))


@query
def monitoring_summary(s):
    s.store("daily_sales")
    performance = durable(monitoring.weekly_forecast_performance(s.baseline), "performance")
    drift = durable(monitoring.demand_drift(s.saved_panel), "drift")
    auc = delivery_risk.holdout_auc(_stated_risk(s).withColumn("in_holdout", F.lit(True))).scalar()
    summary = monitoring.monitoring_summary(performance, drift, s.rules, auc, _stated_anomalies(s))
    return summary.select("*", "thresholds.*").drop("thresholds")


def _kpis(s: Star, improvement: DataFrame | None = None) -> DataFrame:
    s.store("daily_sales")
    return kpis.business_kpis(
        s.raw("daily_sales"),
        s.raw("stock_outs"),
        s.raw("inventory_snapshots"),
        s.raw("skus"),
        s.rules,
        quality.override_summary(s.raw("replenishment_decisions")),
        improvement,
    )


@query
def business_kpis(s):
    names = [
        "forecast_wmape_baseline", "forecast_wmape_advanced", "forecast_accuracy_relative_improvement_pct",
    ]
    return _kpis(s).drop(*names, "targets")


@query
def business_kpis_with_targets(s):
    """All KPIs, those of the forecasts included, and the targets they are held against."""
    s.store("daily_sales")
    row = _kpis(s, durable(forecasting.relative_improvement(s.comparison), "improvement"))
    return row.select("*", *[F.col(f"targets.{n}").alias(f"target_{n}") for n in kpis.PUBLISHED_TARGETS]).drop("targets")


@query
def value_estimate(s):
    return kpis.value_estimate(_kpis(s))


# --- measures ---------------------------------------------------------------------------------------------------


@query
def sales_measures(s):
    return measures.sales_measures(s.fact_sales, ["store_id"])


@query
def stockout_measures(s):
    return measures.stockout_measures(s.fact_sales, s.fact_stockouts)


@query
def lost_sales_measures(s):
    s.store("daily_sales")
    return measures.lost_sales_measures(s.fact_stockouts, s.dim_date, ["store_id"])


@query
def stock_measures(s):
    return measures.stock_measures(s.fact_inventory, ["location_id"])


@query
def turnover_measures(s):
    s.store("daily_sales")
    return measures.turnover_measures(s.fact_sales, s.fact_inventory, s.dim_product, s.dim_date, ["category"])


@query
def order_measures(s):
    return measures.order_measures(s.fact_orders, ["warehouse_id"])


@query
def decision_measures(s):
    return measures.decision_measures(s.fact_decisions, ["location_type"])


@query
def forecast_measures(s):
    return measures.forecast_measures(s.baseline, ["store_id"])


@query
def drift_measures(s):
    return measures.drift_measures(monitoring.demand_drift(s.saved_panel))


@query
def quality_measures(s):
    return measures.quality_measures(s.rules, ["severity"])


@query
def promotion_measures(s):
    return measures.promotion_measures(s.uplift, ["category"])


def _monthly_units(s: Star) -> DataFrame:
    return measures.by_month(s.fact_sales, measures.sales_measures, "date_key").select("month", "units_sold", "revenue")


@query
def units_sold_month_over_month(s):
    return measures.month_over_month(_monthly_units(s), "units_sold").drop("revenue")


@query
def stockout_rate_year_over_year(s):
    monthly = measures.stockout_measures(
        s.fact_sales.select(month_start("date_key").alias("month")),
        s.fact_stockouts.select(month_start("date_key").alias("month"), "stockout_flag"),
        ["month"],
    ).select("month", "stockout_rate")
    return measures.year_over_year_delta(monthly, "stockout_rate").select(
        "month", "stockout_rate", "stockout_rate_yoy_delta"
    )


@query
def period_comparison(s):
    return measures.with_periods(_monthly_units(s), ["units_sold", "revenue"])


@query
def selected_kpi(s):
    shown = {
        "Stockout Rate": "stockout_rate_baseline",
        "Excess Inventory Rate": "excess_inventory_rate_baseline",
        "Inventory Turns": "inventory_turns_baseline",
    }
    table = measures.kpi_table(_kpis(s), shown)
    return measures.selected_kpi(table, "Excess Inventory Rate")


@query
def status_colours(s):
    """Forecast status per store beside the quality status of the run."""
    s.store("daily_sales")
    dq = measures.quality_measures(s.rules).select("dq_status").scalar()
    return (
        measures.forecast_measures(s.baseline, ["store_id"])
        .select("store_id", "forecast_status", dq.alias("dq_status"))
        .withColumn("colour", status_colour("forecast_status", "dq_status"))
    )


@query
def latest_thirteen_weeks(s):
    s.store("daily_sales")
    weekly = panel.weekly_sales(panel.latest_weeks(s.fact_sales, date="date_key"), "date_key")
    return weekly.groupBy("week").agg(F.sum("units_sold").alias("units_sold"))


@query
def regional_planner_view(s):
    return measures.restrict_fact(
        s.fact_stockouts, s.dim_store, "store_id", "Regional Planner", ["ASIA", "EUROPE"]
    )


@query
def category_manager_view(s):
    return measures.restrict_fact(
        s.fact_stockouts, s.dim_product, "sku_id", "Category Manager", ["ECONOMY", "PROMO"]
    )


@query
def regional_planner_orders(s):
    orders = measures.restrict_fact(
        s.fact_orders, s.raw("warehouses"), "warehouse_id", "Regional Planner", ["ASIA", "EUROPE"]
    )
    return orders.groupBy("warehouse_id").agg(F.count("*").alias("orders"), F.sum("quantity_ordered").alias("units"))


@query
def inventory_by_region(s):
    located = measures.with_location(s.fact_inventory, s.dim_store, s.raw("warehouses"))
    return located.groupBy("region", "location_type").agg(
        F.count("*").alias("row_count"), F.sum("on_hand_units").alias("on_hand_units")
    )


# --- report pages -----------------------------------------------------------------------------------------------


@query
def stockout_rate_by_region(s):
    return dashboards.stockout_rate_by_region(s.fact_sales, s.fact_stockouts, s.dim_store)


@query
def inventory_value_by_category(s):
    return dashboards.inventory_value_by_category(s.fact_inventory, s.dim_product)


@query
def error_trend(s):
    return dashboards.error_trend(s.comparison)


@query
def error_by_category(s):
    return dashboards.error_by_category(s.baseline)


@query
def cover_heatmap(s):
    regions = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
    return dashboards.cover_heatmap(s.fact_inventory, s.dim_product, s.dim_store, regions)


@query
def cover_band_composition(s):
    return dashboards.cover_band_composition(s.fact_inventory, s.dim_product)


@query
def stockout_trend(s):
    s.store("daily_sales")
    return dashboards.stockout_trend(s.fact_sales, s.fact_stockouts)


@query
def at_risk_positions(s):
    return dashboards.at_risk_positions(s.fact_inventory, s.recommendations)


@query
def risk_by_category(s):
    return dashboards.risk_by_category(
        dashboards.at_risk_positions(s.fact_inventory, s.recommendations), s.dim_product
    )


@query
def on_time_by_supplier(s):
    return dashboards.on_time_by_supplier(s.performance)


@query
def late_trend(s):
    s.store("purchase_orders")
    return dashboards.late_trend(s.fact_orders)


@query
def promotion_mix(s):
    return dashboards.promotion_mix(s.uplift)


@query
def variance_trend(s):
    return dashboards.variance_trend(s.uplift)
