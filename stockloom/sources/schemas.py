"""Declared schemas of the raw extracts, as DDL; nothing is ever inferred."""

from __future__ import annotations

RAW_SCHEMAS: dict[str, str] = {
    "products": "product_id string, category string, subcategory string, brand string, unit_cost double, "
    "unit_price double, shelf_life_days int, is_seasonal boolean, launch_date date, discontinued boolean",
    "skus": "sku_id string, product_id string, category string, subcategory string, pack_size string, uom string, "
    "barcode string, unit_cost double, unit_price double, case_pack_qty int, discontinued boolean",
    "stores": "store_id string, region string, warehouse_id string, store_format string, size_sqm double, open_date date",
    "warehouses": "warehouse_id string, region string, warehouse_type string, capacity_units int",
    "suppliers": "supplier_id string, supplier_name string, primary_category string, region_of_origin string, "
    "reliability_score double, onboarding_date date",
    "daily_sales": "date date, store_id string, sku_id string, units_sold bigint, revenue double, promo_flag boolean",
    "inventory_snapshots": "date date, location_type string, location_id string, sku_id string, on_hand_units double, "
    "on_order_units double, safety_stock_units double, days_of_supply double",
    "purchase_orders": "po_id string, supplier_id string, sku_id string, warehouse_id string, order_date date, "
    "expected_delivery_date date, actual_delivery_date date, quantity_ordered double, quantity_received double, "
    "unit_cost double, status string",
    "lead_times": "supplier_id string, sku_id string, quoted_lead_time_days double, observed_avg_lead_time_days double, "
    "observed_std_lead_time_days double, on_time_rate double, sample_size bigint",
    "promotions": "promo_id string, sku_id string, start_date date, end_date date, promo_type string, "
    "discount_pct double, planned_uplift_pct double",
    "prices": "sku_id string, effective_date date, list_price double, currency string",
    "markdowns": "markdown_id string, sku_id string, store_id string, date date, markdown_pct int, reason string",
    "holidays": "date date, holiday_name string, region string, impact_level string",
    "weather": "date date, region string, avg_temp_c double, precipitation_mm double, severe_weather_flag boolean",
    "returns": "return_id string, date date, store_id string, sku_id string, quantity bigint, reason string",
    "stock_outs": "date date, store_id string, sku_id string, stockout_flag boolean, lost_sales_units_estimate bigint, "
    "lost_sales_revenue_estimate double",
    "replenishment_decisions": "decision_id string, date date, sku_id string, location_type string, location_id string, "
    "recommended_order_qty double, reorder_point double, safety_stock_units double, approved_qty double, "
    "approver string, override_flag boolean, override_reason string, decision_status string",
}

# Tables the retail extracts are derived from in tests and benchmarks.
SOURCE_SCHEMAS: dict[str, str] = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

SERVICE_LEVEL_SCHEMA = "category string, target_service_level double, rationale string"

# Month partition column of the large tables, by the date column it derives from.
PARTITION_DATES: dict[str, str] = {
    "daily_sales": "date",
    "inventory_snapshots": "date",
    "purchase_orders": "order_date",
    "replenishment_decisions": "date",
    "stock_outs": "date",
    "returns": "date",
    "fact_stockouts": "date_key",
    "fact_daily_sales": "date_key",
    "fact_inventory": "date_key",
    "fact_purchase_orders": "order_date",
    "fact_replenishment_decisions": "date_key",
}
