"""Independent DuckDB SQL for the registered queries.

``STEPS`` are named building blocks over the test tables; ``FINAL`` holds the last SELECT of each query and the double
columns rounded to four decimals. A query text is its last SELECT behind the steps it needs.
"""

from __future__ import annotations

import re
from itertools import product

# Fixed values, stated here once more so that a wrong value in the library shows.
ETS_GRID = list(
    product(
        (0.05, 0.15, 0.25, 0.35, 0.45, 0.55, 0.65, 0.75, 0.85, 0.95),
        (0.01, 0.05, 0.1, 0.2, 0.4),
        (0.8, 0.85, 0.9, 0.95, 0.98),
    )
)
SCENARIOS = (
    ("Baseline", 0.0, 0.0),
    ("Promotional demand surge (+35%)", 0.35, 0.0),
    ("Supplier disruption (+50% lead time)", 0.0, 0.5),
    ("Combined peak-season stress", 0.25, 0.3),
    ("Demand slowdown (-20%)", -0.2, 0.0),
)

def r(expr: str, digits: int) -> str:
    """Half-up rounding through a decimal."""
    return f"round(cast({expr} as decimal(38,8)), {digits})::double"


def ratio(top: str, bottom: str) -> str:
    return f"(({top})::double / nullif(({bottom})::double, 0))"


WMAPE = "sum(abs({a}-{f}))::double / nullif(sum(abs({a}))::double, 0)"


def wmape(a: str, f: str) -> str:
    return "(" + WMAPE.format(a=a, f=f) + ")"


def band(v: str, warn: float, crit: float) -> str:
    return f"case when {v} is null then 'Unknown' when {v} >= {crit} then 'Critical' when {v} >= {warn} then 'Warning' else 'Healthy' end"


def watch(v: str) -> str:
    return f"case when {v} >= 0.3 then 'Critical' when {v} >= 0.2 then 'Watch' else 'Healthy' end"


KINDS = "['ECONOMY','LARGE','MEDIUM','PROMO','SMALL','STANDARD']"
BAND = "floor((p_size-1)/10.0)::int"
SKU = f"p_type || '-' || ({BAND})"

STEPS: dict[str, str] = {}

# --- raw tables -------------------------------------------------------------------------------------------------

STEPS["r_products"] = """
    select 'PROD-' || p_type as product_id, p_type as category, p_type || ' GOODS' as subcategory,
           min(p_brand) as brand, case when p_type <> 'PROMO' then max(p_retailprice) * 0.6::double end as unit_cost,
           max(p_retailprice) as unit_price, (max(p_size) * 7)::int as shelf_life_days,
           p_type in ('PROMO', 'SMALL') as is_seasonal, date '1994-01-01' as launch_date, false as discontinued
    from part group by p_type"""
STEPS["r_skus"] = f"""
    select {SKU} as sku_id, 'PROD-' || p_type as product_id, p_type as category, p_type || ' GOODS' as subcategory,
           'BAND-' || ({BAND}) as pack_size, 'EA' as uom, min(p_partkey)::varchar as barcode,
           max(p_retailprice) * 0.6::double as unit_cost, max(p_retailprice) as unit_price, 4::int as case_pack_qty,
           false as discontinued
    from part group by p_type, {BAND}"""
STEPS["r_stores"] = """
    select 'STR-' || r_regionkey as store_id, r_name as region, 'WH-' || r_regionkey as warehouse_id,
           case when r_regionkey <= 1 then 'Metro' when r_regionkey <= 3 then 'Regional' else 'Express' end as store_format,
           (500 + 250 * r_regionkey)::double as size_sqm, date '1990-01-01' as open_date
    from region"""
STEPS["r_warehouses"] = """
    select 'WH-' || r_regionkey as warehouse_id, r_name as region, 'Regional' as warehouse_type,
           (100000 + 20000 * r_regionkey)::int as capacity_units
    from region"""
STEPS["r_suppliers"] = f"""
    select 'SUP-' || s_suppkey as supplier_id, s_name as supplier_name, ({KINDS})[s_suppkey % 6 + 1] as primary_category,
           r_name as region_of_origin,
           least(0.99::double, greatest(0.5::double, 0.7::double + s_acctbal / 40000)) as reliability_score,
           date '1993-01-01' as onboarding_date
    from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey"""
STEPS["lines"] = f"""
    select l_shipdate::date as date, 'STR-' || n_regionkey as store_id, {SKU} as sku_id, l.*
    from lineitem l join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
    join part on l_partkey = p_partkey"""
STEPS["r_daily_sales"] = """
    select date, store_id, sku_id, units_sold, case when tax > 0 then revenue end as revenue, promo_flag
    from (select date, store_id, sku_id, (sum(l_quantity) * 4)::bigint as units_sold,
                 sum(floor(l_extendedprice * 100 + 0.5)::bigint * floor((1 - l_discount) * 100 + 0.5)::bigint)::double / 10000 as revenue, bool_or(l_discount >= 0.08) as promo_flag,
                 max(l_tax) as tax, max(l_linenumber) as last_line
          from lines group by 1, 2, 3) c
    join (values (1), (2)) as copies(k) on k = 1 or last_line = 7"""
STEPS["r_inventory_snapshots"] = f"""
    select date, location_type, location_id, sku_id, level - 1 as on_hand_units, on_order_units,
           10.0::double as safety_stock_units, level / 20 as days_of_supply
    from (select ts::date as date,
                 case when event_type in ('error', 'signup') then 'Warehouse' else 'Store' end as location_type,
                 case when event_type in ('error', 'signup') then 'WH-' else 'STR-' end || ((user_id // 30) % 5) as location_id,
                 ({KINDS})[(user_id % 30) % 6 + 1] || '-' || ((user_id % 30) // 6) as sku_id,
                 sum(round(value * 100)::bigint)::double / (count(*) * 100) as level,
                 sum(json_extract_string(props, '$.k')::bigint)::double / count(*) as on_order_units
          from events group by 1, 2, 3, 4) s"""
STEPS["r_purchase_orders"] = f"""
    select concat_ws('-', 'PO', l_orderkey, l_linenumber, l_partkey, l_suppkey) as po_id, 'SUP-' || l_suppkey as supplier_id,
           case when p_brand = 'Brand#13' then 'UNREGISTERED-' || p_type else {SKU} end as sku_id,
           'WH-' || (o_custkey % 5) as warehouse_id, o_orderdate::date as order_date,
           o_orderdate::date + quoted as expected_delivery_date, arrived as actual_delivery_date,
           l_quantity * 10 as quantity_ordered,
           case when l_returnflag = 'R' then l_quantity * 9 else l_quantity * 10 end as quantity_received,
           l_extendedprice / l_quantity * 0.6::double as unit_cost,
           case when actual_delivery_date > expected_delivery_date then 'Late' else 'Received' end as status
    from (select *, o_orderdate::date + 1 + ((l_shipdate::date - o_orderdate::date) % 120 + 120)::int % 120 as arrived
          from lineitem join orders on l_orderkey = o_orderkey) o
    join part on l_partkey = p_partkey
    join (values ('1-URGENT', 30), ('2-HIGH', 45), ('3-MEDIUM', 60), ('4-NOT SPECIFIED', 75), ('5-LOW', 90))
         as q(priority, quoted) on priority = o_orderpriority"""
STEPS["r_lead_times"] = f"""
    select supplier_id, sku_id, {r("avg(date_diff('day', order_date, expected_delivery_date))", 1)} as quoted_lead_time_days,
           {r("avg(date_diff('day', order_date, actual_delivery_date))", 1)} as observed_avg_lead_time_days,
           {r("stddev_pop(date_diff('day', order_date, actual_delivery_date))", 2)} as observed_std_lead_time_days,
           {r("avg((actual_delivery_date <= expected_delivery_date)::int)", 3)} as on_time_rate, count(*) as sample_size
    from r_purchase_orders where sku_id in (select sku_id from r_skus) group by 1, 2"""
STEPS["r_stock_outs"] = """
    select date, store_id, sku_id, units >= 10 as stockout_flag, units as lost_sales_units_estimate,
           units * unit_price as lost_sales_revenue_estimate
    from (select date, store_id, sku_id, sum(l_quantity)::bigint as units from lines
          where l_returnflag = 'R' and l_linestatus = 'O' group by 1, 2, 3) x
    join r_skus using (sku_id)"""
STEPS["r_replenishment_decisions"] = f"""
    select 'DEC-' || o_orderkey as decision_id, o_orderdate::date as date,
           ({KINDS})[(o_orderkey % 30) % 6 + 1] || '-' || ((o_orderkey % 30) // 6) as sku_id,
           case when o_custkey % 7 = 0 then 'Warehouse' else 'Store' end as location_type,
           case when o_custkey % 7 = 0 then 'WH-' else 'STR-' end || (o_custkey % 5) as location_id,
           wanted as recommended_order_qty, wanted / 2 as reorder_point, wanted / 4 as safety_stock_units,
           case when planner then floor(wanted * 0.75::double) else wanted end as approved_qty,
           case when planner then 'Planner Review' else 'System Auto-Replenishment' end as approver,
           planner as override_flag, case when planner then 'Priority ' || o_orderpriority else '' end as override_reason,
           case when planner then 'Manual override' else 'Auto-approved' end as decision_status
    from (select *, floor(o_totalprice / 1000) as wanted,
                 o_orderstatus = 'P' and o_orderpriority in ('1-URGENT', '2-HIGH') as planner from orders) o"""
STEPS["r_returns"] = """
    select concat_ws('-', 'RET', date, store_id, sku_id) as return_id, date, store_id, sku_id,
           sum(l_quantity)::bigint as quantity, 'Customer change of mind' as reason
    from lines where l_returnflag = 'R' and l_linestatus = 'F' group by date, store_id, sku_id"""
STEPS["r_markdowns"] = """
    select concat_ws('-', 'MKD', date, store_id, sku_id) as markdown_id, sku_id, store_id, date,
           case when count(*) > 1 then 25 else 15 end as markdown_pct, 'Clearance' as reason
    from lines where l_returnflag = 'N' and l_discount >= 0.1 group by date, store_id, sku_id"""
STEPS["r_promotions"] = f"""
    select concat_ws('-', 'PROMO', ordinal, year) as promo_id, sku_id, start_date,
           start_date + (13 - ordinal % 3)::int as end_date,
           (['BOGO', 'Feature Display', 'Multi-buy', 'Percent Off'])[ordinal % 4 + 1] as promo_type,
           (10 + ordinal % 3 * 5)::double as discount_pct,
           ([75.0, 15.0, 40.0, 25.0])[ordinal % 4 + 1]::double as planned_uplift_pct
    from (select sku_id, ordinal, year, make_date(year, 1, 1) + (ordinal * 11)::int as start_date
          from (select sku_id, list_position({KINDS}, category) - 1 + split_part(sku_id, '-', 2)::int * 6 as ordinal
                from r_skus) s, (select unnest(generate_series(1996, 2000)) as year) y) p"""
STEPS["r_prices"] = f"""
    select {SKU} as sku_id, date '1995-01-01' as effective_date, min(p_retailprice) as list_price, 'AUD' as currency
    from part group by 1
    union all
    select {SKU}, date '1998-01-01', max(p_retailprice), 'AUD' from part group by 1"""
STEPS["region_days"] = """
    select r_regionkey, r_name, d::date as date
    from region, (select unnest(generate_series(min(l_shipdate)::date, max(l_shipdate)::date, interval 1 day)) as d
                  from lineitem) days"""
STEPS["r_weather"] = """
    select date, r_name as region, 15 + 10 * cos(2 * pi() * (dayofyear(date) - 20) / 365) + r_regionkey as avg_temp_c,
           case when not (r_regionkey = 2 and date between '1996-03-04' and '1996-03-10') then rain end as precipitation_mm,
           rain >= 14 as severe_weather_flag
    from (select *, ((dayofyear(date) * 7 + r_regionkey * 13) % 30) / 2.0::double as rain from region_days) w"""
STEPS["r_holidays"] = """
    select date, name as holiday_name, r_name as region, impact as impact_level
    from region_days join (values (1, 1, 'New Year', 'High'), (4, 25, 'Spring Day', 'Low'), (12, 25, 'Midwinter Day', 'High'))
         as h(m, d, name, impact) on month(date) = m and day(date) = d
    where m <> 4 or r_regionkey % 2 = 0"""

# --- silver and gold --------------------------------------------------------------------------------------------

STEPS["s_skus"] = "select * from r_skus where product_id in (select product_id from r_products)"
# A cell counts once however often it was loaded; missing revenue is priced in a step of its own.
STEPS["sales_cells"] = """
    select date, store_id, sku_id, units_sold, revenue as booked, promo_flag, count(*) as loads
    from r_daily_sales where sku_id in (select sku_id from s_skus) group by 1, 2, 3, 4, 5, 6"""
STEPS["sales_priced"] = """
    select date, store_id, sku_id, units_sold, units_sold * unit_price as revenue, promo_flag
    from sales_cells join s_skus using (sku_id) where booked is null"""
STEPS["s_sales"] = """
    select *, units_sold >= 200 as is_volume_outlier
    from (select date, store_id, sku_id, units_sold, booked as revenue, promo_flag from sales_cells where booked is not null
          union all from sales_priced) c"""
# Sound and impossible stock levels are told apart first; the impossible ones then count as empty shelves.
STEPS["impossible_stock"] = "select * from r_inventory_snapshots where on_hand_units < 0"
STEPS["sound_stock"] = "select * from r_inventory_snapshots where on_hand_units >= 0"
STEPS["s_inventory"] = """
    select date, location_type, location_id, sku_id, on_hand_units, on_order_units, safety_stock_units, days_of_supply,
           false as had_negative_on_hand_defect
    from sound_stock
    union all
    select date, location_type, location_id, sku_id, 0, on_order_units, safety_stock_units, days_of_supply, true
    from impossible_stock"""
STEPS["s_orders"] = "select * from r_purchase_orders where sku_id in (select sku_id from s_skus)"
STEPS["s_weather"] = """
    select w.date, w.region, ifnull(w.avg_temp_c, m.t) as avg_temp_c, ifnull(w.precipitation_mm, m.p) as precipitation_mm,
           w.severe_weather_flag
    from r_weather w join (select region, avg(avg_temp_c) as t, avg(precipitation_mm) as p from r_weather group by 1) m
         using (region)"""
STEPS["g_date"] = """
    select d::date as date_key, year(d)::int as year, month(d)::int as month, weekofyear(d)::int as iso_week,
           dayofweek(d)::int as day_of_week, dayofweek(d) in (0, 6) as is_weekend
    from (select unnest(generate_series(min(date), max(date), interval 1 day)) as d from s_sales) x"""
STEPS["g_product"] = """
    select k.sku_id, k.product_id, p.category, p.subcategory, p.brand, k.pack_size, k.uom, k.unit_cost, k.unit_price,
           p.shelf_life_days, p.is_seasonal, k.discontinued
    from s_skus k, r_products p where p.product_id = k.product_id"""
STEPS["g_store"] = """
    select store_id, region, warehouse_id, store_format, size_sqm, open_date from r_stores
    where warehouse_id in (select warehouse_id from r_warehouses)"""
STEPS["g_sales"] = "select date as date_key, * exclude (date) from s_sales"
STEPS["g_inventory"] = "select date as date_key, * exclude (date) from s_inventory"
STEPS["g_orders"] = "select *, actual_delivery_date > expected_delivery_date as is_late from s_orders"
STEPS["g_stockouts"] = "select date as date_key, * exclude (date) from r_stock_outs"
STEPS["g_decisions"] = "select date as date_key, * exclude (date) from r_replenishment_decisions"
STEPS["performance"] = """
    select supplier_id, any_value(supplier_name) as supplier_name, any_value(reliability_score) as reliability_score,
           any_value(region_of_origin) as region_of_origin, count(*) as purchase_orders,
           avg(is_late::int) as late_rate, avg(actual_delivery_date - order_date) as avg_actual_lead_time_days,
           avg(quantity_received / nullif(quantity_ordered, 0)) as avg_fill_rate
    from r_suppliers join g_orders using (supplier_id) group by supplier_id"""

# --- marts ------------------------------------------------------------------------------------------------------

STEPS["staged_inventory"] = """
    select date as snapshot_date, location_type, location_id, sku_id, on_hand_units, on_order_units, days_of_supply
    from s_inventory"""

# --- panel and forecasts ----------------------------------------------------------------------------------------

STEPS["weekly"] = """
    select store_id, sku_id, date_trunc('week', date)::date as week, sum(units_sold)::bigint as units_sold,
           sum(revenue) as revenue, bool_or(promo_flag) as promo_flag
    from r_daily_sales group by 1, 2, 3"""
STEPS["located"] = """
    select w.*, k.category, k.unit_price, t.region, t.store_format, temp, rain, holidays
    from weekly w join r_skus k using (sku_id) join r_stores t using (store_id)
    left join (select region, date_trunc('week', date)::date as week, avg(avg_temp_c) as temp,
                      avg(precipitation_mm) as rain from r_weather group by 1, 2) c
         on c.region = t.region and c.week = w.week
    left join (select region, date_trunc('week', date)::date as week, count(*) as holidays from r_holidays group by 1, 2) h
         on h.region = t.region and h.week = w.week"""
STEPS["panel"] = """
    select store_id, sku_id, category, region, store_format, week, units_sold, revenue, promo_flag, unit_price,
           ifnull(temp, (select median(temp) from located)) as avg_temp_c,
           ifnull(rain, (select median(rain) from located)) as precipitation_mm,
           ifnull(holidays, 0) as holiday_count, weekofyear(week)::int as week_of_year, month(week)::int as month,
           sin(2 * pi() * weekofyear(week) / 52) as week_sin, cos(2 * pi() * weekofyear(week) / 52) as week_cos,
           (select count(distinct f.store_format) from located f where f.store_format < l.store_format)::int as store_format_enc,
           (select count(distinct f.category) from located f where f.category < l.category)::int as category_enc,
           lag(units_sold) over w as lag_1, lag(units_sold, 2) over w as lag_2, lag(units_sold, 4) over w as lag_4,
           avg(units_sold) over before as rolling_mean_4,
           ifnull(stddev_samp(units_sold) over before, 0) as rolling_std_4
    from located l
    window w as (partition by store_id, sku_id order by week),
           before as (partition by store_id, sku_id order by week rows between 4 preceding and 1 preceding)"""
STEPS["cutoff"] = "select min(week) as c from (select distinct week from panel order by week desc limit 8)"
STEPS["train"] = "select * from panel where week < (select c from cutoff) and lag_4 is not null"
STEPS["test"] = "select * from panel where week >= (select c from cutoff)"
STEPS["baseline"] = "select *, ifnull(ifnull(rolling_mean_4, lag_1), 0)::double as forecast_units from test"
STEPS["comparison"] = """
    select store_id, sku_id, week, category, units_sold, forecast_units as forecast_units_advanced,
           ifnull(lag_1, 0)::double as forecast_units_baseline
    from baseline"""
STEPS["sku_forecast"] = "select sku_id, week, sum(forecast_units) as sku_units from baseline group by 1, 2"
STEPS["points"] = """
    select sku_id, week, units, t, n from (
        select sku_id, week, sum(units_sold) as units, row_number() over (partition by sku_id order by week) as t,
               count(*) over (partition by sku_id) as n
        from panel group by 1, 2) p
    where n >= 16"""
STEPS["fit_points"] = "select sku_id, t, greatest(units::double, 0.1::double) as y from points where t <= n - 8"
STEPS["start_state"] = """
    select sku_id, ym - slope * tm as l0, slope as b0 from (
        select sku_id, avg(y) as ym, avg(t) as tm, regr_slope(y, t) as slope from fit_points where t <= 10 group by 1) s"""
STEPS["grid"] = "select * from (values " + ", ".join(
    f"({i}, {a}::double, {b}::double, {p}::double)" for i, (a, b, p) in enumerate(ETS_GRID)
) + ") as g(i, alpha, beta, phi)"
STEPS["fold"] = """
    select sku_id, i, alpha, beta, phi, 0::bigint as t, l0 as l, b0 as b, 0.0::double as sse from start_state, grid
    union all
    select f.sku_id, i, alpha, beta, phi, p.t,
           alpha * y + (1 - alpha) * (l + phi * b),
           beta * ((alpha * y + (1 - alpha) * (l + phi * b)) - l) + (1 - beta) * phi * b,
           sse + (y - (l + phi * b)) * (y - (l + phi * b))
    from fold f join fit_points p on p.sku_id = f.sku_id and p.t = f.t + 1"""
STEPS["best_fit"] = """
    select sku_id, l, b, phi from (
        select f.*, row_number() over (partition by f.sku_id order by sse, i) as place
        from fold f join (select sku_id, max(t) as last from fit_points group by 1) e on e.sku_id = f.sku_id and t = last) x
    where place = 1"""
STEPS["smoothing"] = """
    select sku_id, week, units::bigint as actual_units,
           greatest(l + b * phi * (1 - power(phi, h)) / (1 - phi), 0) as forecast_units
    from (select p.sku_id, p.week, p.units, t - (n - 8) as h, l, b, phi from points p join best_fit using (sku_id)
          where t > n - 8) q"""


def by_level(rows: str, method: str, levels: tuple[str, ...]) -> str:
    keys = {"Store-SKU": "store_id || '|' || sku_id", "SKU": "sku_id", "Category": "category", "Total": "'all'"}
    parts = [
        f"select '{level}' as level, series, week, sum(units_sold)::double as a, sum(forecast_units) as f "
        f"from (select *, {keys[level]} as series from {rows}) group by series, week"
        for level in levels
    ]
    return f"""
    select level, '{method}' as method, {r(wmape("a", "f"), 4)} as wmape,
           {r("avg(abs((a - f) / nullif(a, 0))) filter (where abs(a) > 0.000001)", 4)} as mape,
           {r("avg(f - a) / nullif(avg(a), 0)", 4)} as bias, {r(f"(1 - {wmape('a', 'f')}) * 100", 2)} as accuracy_pct,
           count(distinct series) as n_series
    from ({" union all ".join(parts)}) x group by level"""


STEPS["split_rows"] = """
    select b.store_id, b.sku_id, b.week, b.category, b.units_sold,
           sku_units * coalesce(v.volume / nullif(t.total, 0)::double, 1.0 / (select count(distinct store_id) from baseline))
               as forecast_units
    from baseline b join sku_forecast f using (sku_id, week)
    join (select sku_id, store_id, sum(units_sold) as volume from baseline group by 1, 2) v using (sku_id, store_id)
    join (select sku_id, sum(units_sold) as total from baseline group by 1) t using (sku_id)"""
STEPS["split_train_rows"] = """
    select b.store_id, b.sku_id, b.week, b.category, b.units_sold,
           sku_units * coalesce(v.volume / nullif(t.total, 0)::double, 1.0 / (select count(distinct store_id) from train))
               as forecast_units
    from baseline b join sku_forecast f using (sku_id, week)
    join (select sku_id, store_id, sum(units_sold) as volume from train group by 1, 2) v using (sku_id, store_id)
    join (select sku_id, sum(units_sold) as total from train group by 1) t using (sku_id)"""
# Written out as the plain join of shares and actuals on SKU and week.
STEPS["pair_rows"] = """
    select f.sku_id, f.week, a.category, a.units_sold, sku_units * share as forecast_units
    from sku_forecast f
    join (select sku_id, store_id, coalesce(volume / nullif(sum(volume) over (partition by sku_id), 0)::double,
                                            1.0 / (select count(distinct store_id) from baseline)) as share
          from (select sku_id, store_id, sum(units_sold) as volume from baseline group by 1, 2)) s on s.sku_id = f.sku_id
    join baseline a on a.sku_id = f.sku_id and a.week = f.week"""

# --- inventory --------------------------------------------------------------------------------------------------

STEPS["demand"] = """
    select store_id, sku_id, avg(units_sold) as demand_mean,
           ifnull(stddev_samp(units_sold), avg(units_sold) * 0.3::double) as demand_std
    from r_daily_sales where date > (select max(date) - 56 from r_daily_sales) group by 1, 2"""
STEPS["sourced"] = """
    select d.*, k.category, k.unit_cost, t.supplier_id, t.observed_avg_lead_time_days as lt,
           t.observed_std_lead_time_days as ls, t.on_time_rate
    from demand d left join r_skus k using (sku_id) left join r_lead_times t on t.sku_id = k.sku_id"""


def recommendations(z: str, holding: str) -> str:
    return f"""
    select store_id, sku_id, {r("demand_mean", 2)} as demand_mean_daily, {r("demand_std", 2)} as demand_std_daily,
           {r("lead", 1)} as lead_time_days, {r("spread", 2)} as lead_time_std_days, z as service_level_z,
           {r("ss", 1)} as safety_stock_units, {r("demand_mean * lead + ss", 1)} as reorder_point_units,
           {r("sqrt(2 * demand_mean * 365 * 45 / holding)", 0)} as economic_order_qty_units,
           on_time_rate as supplier_on_time_rate
    from (select *, z * sqrt(greatest(lead * demand_std * demand_std + demand_mean * demand_mean * spread * spread, 0)) as ss
          from (select *, ifnull(lt, (select median(lt) from sourced)) as lead, ifnull(ls, 1.5) as spread,
                       {z} as z, {holding} * 0.22::double as holding from sourced) a) b"""


STEPS["recs"] = recommendations("1.65::double", "greatest(demand_mean, 0.1)")


def shocked(d: str, lt: str, source: str) -> str:
    return f"""
    select * replace (m as demand_mean_daily, s as demand_std_daily, t as lead_time_days, u as lead_time_std_days,
                      {r("ss", 1)} as safety_stock_units, {r("m * t + ss", 1)} as reorder_point_units)
    from (select *, 1.65::double * sqrt(greatest(t * s * s + m * m * u * u, 0)) as ss
          from (select *, demand_mean_daily * (1 + {d}) as m,
                       demand_std_daily * (1 + greatest({d}, 0) * 0.6::double + abs(least({d}, 0)) * 0.3::double) as s,
                       lead_time_days * (1 + {lt}) as t,
                       lead_time_std_days * (1 + greatest({lt}, 0) * 0.8::double) as u from {source}) a) b"""


STEPS["cases"] = "select * from (values " + ", ".join(
    f"('{n}', {d}::double, {lt}::double)" for n, d, lt in SCENARIOS
) + ") as c(scenario, demand_shock_pct, lead_time_shock_pct)"
STEPS["cased"] = "select * from recs, cases"
STEPS["newest"] = """
    select * from (select *, row_number() over (partition by location_type, location_id, sku_id order by date desc) as place
                   from r_inventory_snapshots) x where place = 1"""
STEPS["points_by_store"] = "select store_id, sku_id, max(reorder_point_units) as rop from recs group by 1, 2"
STEPS["requests"] = """
    select n.location_id as store_id, n.sku_id, n.date as snapshot_date, n.on_hand_units, n.on_order_units, n.days_of_supply,
           rop as reorder_point_units, rop * 1.7::double - (n.on_hand_units + n.on_order_units) as request_qty
    from newest n join points_by_store p on p.store_id = n.location_id and p.sku_id = n.sku_id
    where n.location_type = 'Store' and n.on_hand_units + n.on_order_units < rop"""

# --- promotions, anomalies, risk --------------------------------------------------------------------------------

STEPS["uplift_lines"] = """
    select p.*, s.date, s.units_sold, isodow(s.date) as wd, s.date >= p.start_date as during
    from r_promotions p join r_daily_sales s on s.sku_id = p.sku_id and s.date between p.start_date - 21 and p.end_date"""
STEPS["uplift_rows"] = """
    select l.*, coalesce(w.m, a.m) as expected
    from uplift_lines l
    join (select promo_id, avg(units_sold) as m from uplift_lines where not during group by 1) a using (promo_id)
    left join (select promo_id, wd, avg(units_sold) as m from uplift_lines where not during group by 1, 2) w
         on w.promo_id = l.promo_id and w.wd = l.wd
    where l.during"""
STEPS["uplift"] = f"""
    select promo_id, sku_id, promo_type, start_date, end_date, (end_date - start_date + 1)::int as duration_days,
           actual::bigint as actual_units, {r("expected", 1)} as expected_units_baseline,
           {r("actual - expected", 1)} as uplift_units,
           {r("case when expected > 0 then (actual - expected) / expected * 100 end", 1)} as uplift_pct,
           planned_uplift_pct, category
    from (select promo_id, sku_id, promo_type, start_date, end_date, planned_uplift_pct, sum(units_sold) as actual,
                 sum(expected) as expected from uplift_rows group by all) u join r_skus using (sku_id)"""
STEPS["stock_features"] = """
    select *, avg(days_of_supply) over w4 as dos_rolling_mean, ifnull(stddev_samp(days_of_supply) over w4, 0) as dos_rolling_std,
           ifnull(days_of_supply - lag(days_of_supply) over w, 0) as dos_change, on_hand_units < 0 as is_negative_on_hand
    from r_inventory_snapshots
    window w as (partition by location_id, sku_id order by date),
           w4 as (partition by location_id, sku_id order by date rows between 3 preceding and current row)"""
STEPS["step_scores"] = "select *, abs(dos_change) + abs(on_hand_units) / 100 as anomaly_score from stock_features"
STEPS["flagged"] = """
    select strftime(date, '%Y-%m-%d') as date, location_type, location_id, sku_id, on_hand_units, on_order_units, days_of_supply,
           anomaly_score,
           case when is_negative_on_hand then 'Negative on-hand (data defect)' when dos_change < -3 then 'Unexplained inventory drop'
                when dos_change > 3 then 'Unexplained inventory build-up' else 'Abnormal stock position' end as anomaly_type
    from step_scores
    where is_negative_on_hand or anomaly_score >= (select quantile_cont(anomaly_score, 0.98) from step_scores)"""
STEPS["order_features"] = """
    select o.po_id, o.supplier_id, o.sku_id, (actual_delivery_date > expected_delivery_date)::int as is_late,
           (expected_delivery_date - order_date)::int as quoted_lead_time_days, month(order_date)::int as order_month,
           s.reliability_score, s.region_of_origin, k.category
    from r_purchase_orders o join r_skus k using (sku_id) left join r_suppliers s on s.supplier_id = o.supplier_id"""
STEPS["stated_risk"] = """
    select *, (1 - reliability_score) * 45 / quoted_lead_time_days as late_risk_score from order_features"""

# --- quality ----------------------------------------------------------------------------------------------------


# Number, table, field, expectation, threshold, severity, owner, what holds for a sound row.
RULES = (
    ("DQ-001", "products", "product_id", "unique_and_not_null", 1.0, "critical", "Product Data Steward", "product_id is not null and count(*) over (partition by product_id) = 1"),
    ("DQ-002", "skus", "sku_id", "unique_and_not_null", 1.0, "critical", "Product Data Steward", "sku_id is not null and count(*) over (partition by sku_id) = 1"),
    ("DQ-003", "suppliers", "supplier_id", "unique_and_not_null", 1.0, "critical", "Supplier Data Steward", "supplier_id is not null and count(*) over (partition by supplier_id) = 1"),
    ("DQ-004", "skus", "product_id", "referential_product", 1.0, "critical", "Product Data Steward", "product_id in (select product_id from r_products)"),
    ("DQ-005", "stores", "warehouse_id", "referential_warehouse", 1.0, "critical", "Location Data Steward", "warehouse_id in (select warehouse_id from r_warehouses)"),
    ("DQ-006", "purchase_orders", "sku_id", "referential_sku", 1.0, "critical", "Supply Chain Data Steward", "sku_id in (select sku_id from r_skus)"),
    ("DQ-007", "products", "unit_cost", "not_null", 0.98, "high", "Finance Data Steward", "unit_cost is not null"),
    ("DQ-008", "daily_sales", "revenue", "not_null", 0.98, "high", "Sales Data Steward", "revenue is not null"),
    ("DQ-009", "daily_sales", "units_sold", "below_200", 0.999, "medium", "Store Operations", "ifnull(units_sold < 200, true)"),
    ("DQ-010", "inventory_snapshots", "on_hand_units", "non_negative", 0.999, "critical", "Inventory Data Steward", "ifnull(on_hand_units >= 0, true)"),
    ("DQ-011", "skus", "unit_price", "between_0.5_and_500", 1.0, "medium", "Pricing Data Steward", "ifnull(unit_price between 0.5 and 500, true)"),
)


def rule_line(number, table, field, what, threshold, severity, owner, sound) -> str:
    return (
        f"select '{number}' as id, '{table}' as \"table\", '{field}' as field, '{what}' as expectation, "
        f"{threshold}::double as threshold, '{severity}' as severity, '{owner}' as owner, "
        f"{r('avg(ok::int)', 4)} as pass_rate, count(*) as rows_checked, "
        f"count(*) filter (where not ok) as rows_failed, avg(ok::int) >= {threshold} as passed "
        f"from (select {sound} as ok from r_{table}) x"
    )


STEPS["rules"] = "\n    union all ".join(rule_line(*rule) for rule in RULES)

# --- monitoring -------------------------------------------------------------------------------------------------

STEPS["weekly_errors"] = f"""
    select week, {r("w", 4)} as wmape, n_series, {band("w", 0.2, 0.28)} as status
    from (select week, {wmape("units_sold", "forecast_units")} as w, count(*) as n_series from baseline group by 1) x"""
STEPS["week_numbers"] = "select week, row_number() over (order by week) as k, count(*) over () as n from (select distinct week from panel)"
STEPS["drift_rows"] = """
    select feature, value, side from (
        select p.units_sold::double as units_sold, p.unit_price, p.avg_temp_c, side
        from panel p join (select week, 'ref' as side from week_numbers where k <= 12
                           union all select week, 'cur' from week_numbers where k > n - 12) w using (week)) x
    unpivot (value for feature in (units_sold, unit_price, avg_temp_c))"""
STEPS["drift_edges"] = """
    select feature, list_sort(list_distinct(quantile_cont(value, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]))) as edges
    from drift_rows where side = 'ref' group by 1"""
STEPS["drift_buckets"] = """
    select feature, unnest(range(1, len(edges))) as i, edges from drift_edges"""
STEPS["drift_counts"] = """
    select b.feature, b.i, count(*) filter (where side = 'ref') as nr, count(*) filter (where side = 'cur') as nc
    from drift_buckets b left join drift_rows d on d.feature = b.feature and d.value >= b.edges[b.i]
         and (d.value < b.edges[b.i + 1] or (b.i = len(b.edges) - 1 and d.value = b.edges[b.i + 1]))
    group by 1, 2"""
STEPS["drift"] = f"""
    select feature, {r("psi", 4)} as psi, {band("psi", 0.1, 0.25)} as status
    from (select feature, sum((c - p) * ln(c / p)) as psi
          from (select feature, greatest(nr::double / sum(nr) over (partition by feature), 0.0001) as p,
                       greatest(nc::double / sum(nc) over (partition by feature), 0.0001) as c from drift_counts) x
          group by 1) y"""
STEPS["override_totals"] = f"""
    select count(*) as total_decisions, count(*) filter (where override_flag) as override_count,
           {r("avg(override_flag::int)", 4)} as override_rate, {r("1 - avg(override_flag::int)", 4)} as auto_approved_rate
    from r_replenishment_decisions"""
STEPS["kpi_parts"] = """
    select (select count(*) from r_stock_outs)::double / (select count(*) from r_daily_sales) as stockout,
           (select avg((days_of_supply > 6)::int) from r_inventory_snapshots where location_type = 'Store') as excess,
           (select sum(units_sold * unit_cost) from r_daily_sales join r_skus using (sku_id)) * 365
               / (select greatest(max(date) - min(date), 1) from r_daily_sales) as cogs,
           (select sum(lost_sales_revenue_estimate) from r_stock_outs) * 365
               / (select greatest(max(date) - min(date), 1) from r_daily_sales) as lost,
           (select avg(v) from (select date, sum(greatest(on_hand_units, 0) * unit_cost) as v
                                from r_inventory_snapshots join r_skus using (sku_id)
                                where location_type = 'Store' group by 1)) as stock,
           (select avg(pass_rate) from rules) as dq, (select override_rate from override_totals) as override_rate"""
STEPS["stated_auc"] = f"""
    with scores as (select late_risk_score as v, sum(is_late) as late, count(*) - sum(is_late) as punctual from stated_risk group by 1),
         ranked as (select late, punctual, sum(punctual) over (order by v) as upto from scores)
    select {r("sum(late * (upto - punctual / 2.0::double)) / (sum(late)::double * sum(punctual)::double)", 4)} as auc from ranked"""
STEPS["kpis"] = f"""
    select {r("stockout", 4)} as stockout_rate_baseline, {r("stockout * (1 - 0.2::double)", 4)} as stockout_rate_target,
           {r("excess", 4)} as excess_inventory_rate_baseline,
           {r("excess * (1 - 0.15::double)", 4)} as excess_inventory_rate_target,
           {r("cogs / stock", 2)} as inventory_turns_baseline, {r("cogs / stock * (1 + 0.05::double)", 2)} as inventory_turns_target,
           override_rate as manual_override_rate_baseline, {r("dq", 4)} as data_quality_pass_rate,
           {r("cogs", 0)} as annualised_cogs_estimate_aud, {r("lost", 0)} as annual_lost_sales_estimate_aud,
           {r("stock", 2)} as mean_inventory_value_aud
    from kpi_parts"""
STEPS["history_days"] = "select max(date_key) - min(date_key) as n from g_date"
STEPS["monthly"] = """
    select date_trunc('month', date_key)::date as month, sum(units_sold)::bigint as units_sold, sum(revenue) as revenue
    from g_sales group by 1"""
STEPS["monthly_stockouts"] = """
    select s.month, ifnull(o.n, 0)::double / s.n as stockout_rate
    from (select date_trunc('month', date_key)::date as month, count(*) as n from g_sales group by 1) s
    left join (select date_trunc('month', date_key)::date as month, count(*) filter (where stockout_flag) as n
               from g_stockouts group by 1) o using (month)"""
STEPS["newest_gold"] = """
    select * from (select *, row_number() over (partition by location_type, location_id, sku_id order by date_key desc) as place
                   from g_inventory) x where place = 1"""
STEPS["positions"] = f"""
    select n.location_id as store_id, n.sku_id, on_hand_units + on_order_units as position_units, rop as reorder_point_units,
           {ratio("rop", "on_hand_units + on_order_units")} as risk_ratio, on_hand_units + on_order_units < rop as at_risk
    from newest_gold n join points_by_store p on p.store_id = n.location_id and p.sku_id = n.sku_id
    where n.location_type = 'Store'"""

# --- last step of each query ------------------------------------------------------------------------------------

FINAL: dict[str, tuple[str, str]] = {}


def final(name: str, sql: str, doubles: str = "") -> None:
    FINAL[name] = (sql, doubles)


final("raw_extract_round_trip", """
    select 'daily_sales' as table_name, store_id, count(*) as row_count, sum(units_sold)::bigint as units from r_daily_sales group by 2
    union all select 'stock_outs', store_id, count(*), sum(lost_sales_units_estimate)::bigint from r_stock_outs group by 2
    union all select 'returns', store_id, count(*), sum(quantity)::bigint from r_returns group by 2""")
final("gold_layer_by_month", """
    select 'fact_daily_sales' as table_name, date_trunc('month', date_key)::date as load_month, count(*) as row_count from g_sales group by 2
    union all select 'fact_purchase_orders', date_trunc('month', order_date)::date, count(*) from g_orders group by 2""")
RAW = ["products", "skus", "stores", "warehouses", "suppliers", "daily_sales", "inventory_snapshots", "purchase_orders",
       "lead_times", "promotions", "prices", "markdowns", "holidays", "weather", "returns", "stock_outs",
       "replenishment_decisions"]
final("bronze_row_counts", " union all ".join(
    f"select 'bronze' as layer, '{n}' as table_name, count(*) as row_count from r_{n}" for n in RAW))
SILVER = {"skus": "s_skus", "stores": "g_store", "daily_sales": "s_sales", "inventory_snapshots": "s_inventory",
          "purchase_orders": "s_orders"}
GOLD = {"fact_daily_sales": ("g_sales", "s_sales", ["units_sold", "revenue"]),
        "fact_inventory": ("g_inventory", "s_inventory", ["on_hand_units"]),
        "fact_purchase_orders": ("g_orders", "s_orders", ["quantity_ordered", "quantity_received"])}
final("layer_reconciliation", " union all ".join(
    [f"select 'silver {n} within bronze' as \"check\", (select count(*)::double from {t}) as left_value, "
     f"(select count(*)::double from r_{n}) as right_value, true as passed" for n, t in SILVER.items()]
    + [f"select 'gold {n} rows', (select count(*)::double from {g}), (select count(*)::double from {s}), true"
       for n, (g, s, _) in GOLD.items()]
    + [f"select 'gold {n} {c}', (select {r(f'sum({c})', 2)} from {g}), (select {r(f'sum({c})', 2)} from {s}), true"
       for n, (g, s, cs) in GOLD.items() for c in cs]))
final("silver_products", "select * from r_products where product_id is not null", "unit_cost unit_price")
final("silver_skus", "select * from s_skus", "unit_cost unit_price")
final("silver_stores", "select store_id, region, warehouse_id, store_format, size_sqm, open_date from g_store", "size_sqm")
final("silver_daily_sales", "select * from s_sales", "revenue")
final("silver_inventory_snapshots", "select * from s_inventory", "on_hand_units on_order_units safety_stock_units days_of_supply")
final("silver_purchase_orders", "select * from s_orders", "quantity_ordered quantity_received unit_cost")
final("silver_weather", "select * from s_weather", "avg_temp_c precipitation_mm")
final("silver_pass_through", " union all ".join(
    f"select '{n}' as table_name, count(*) as row_count, {x}::double as total from r_{n}" for n, x in {
        "warehouses": "sum(capacity_units)", "suppliers": "sum(reliability_score)", "lead_times": "sum(sample_size)",
        "promotions": "sum(planned_uplift_pct)", "prices": "sum(list_price)", "markdowns": "sum(markdown_pct)",
        "holidays": "count(*)", "returns": "sum(quantity)", "stock_outs": "sum(lost_sales_units_estimate)",
        "replenishment_decisions": "sum(approved_qty)"}.items()), "total")
final("gold_dim_date", "select * from g_date")
final("gold_dim_product", "select * from g_product", "unit_cost unit_price")
final("gold_dim_store", "select * from g_store", "size_sqm")
final("gold_fact_daily_sales", "select * from g_sales", "revenue")
final("gold_fact_inventory", "select * from g_inventory", "on_hand_units on_order_units safety_stock_units days_of_supply")
final("gold_fact_purchase_orders", "select * from g_orders", "quantity_ordered quantity_received unit_cost")
final("gold_fact_stockouts", "select * from g_stockouts", "lost_sales_revenue_estimate")
final("gold_fact_replenishment_decisions", "select * from g_decisions",
      "recommended_order_qty reorder_point safety_stock_units approved_qty")
final("supplier_performance", "select * from performance",
      "reliability_score late_rate avg_actual_lead_time_days avg_fill_rate")
final("supplier_scorecard", f"""
    select supplier_id, supplier_name, region_of_origin, reliability_score, purchase_orders,
           {r("late_rate * 100", 1)} as late_rate_pct, {r("avg_actual_lead_time_days", 1)} as avg_actual_lead_time_days,
           {r("avg_fill_rate * 100", 1)} as avg_fill_rate_pct, {watch("late_rate")} as delivery_status
    from performance""", "reliability_score")
final("worst_suppliers", """
    select supplier_id, late_rate, purchase_orders from performance order by late_rate desc, supplier_id limit 5""", "late_rate")

final("staged_inventory", "select * from staged_inventory", "on_hand_units on_order_units days_of_supply")
final("enriched_sales", f"""
    select k.category, s.store_id, t.store_format, t.region, s.promo_flag, count(*) as row_count,
           sum(units_sold)::bigint as units_sold, count(cents) as rows_with_revenue,
           round(sum(cents)::double, 0) as revenue,
           round(avg(cents::double / nullif(units_sold, 0)), 2) as revenue_per_unit
    from (select *, round(revenue::decimal(38,8), 2) as cents from r_daily_sales where units_sold >= 0) s
    join r_skus k using (sku_id) join r_stores t using (store_id) group by 1, 2, 3, 4, 5""")
final("category_stock_mart", """
    select category, count(*) as snapshot_rows, avg(days_of_supply) as avg_days_of_supply,
           avg((days_of_supply > 6)::int) as excess_stock_rate
    from staged_inventory join r_skus using (sku_id) where location_type = 'Store' group by 1""",
      "avg_days_of_supply excess_stock_rate")
final("inventory_health", f"""
    select category, {r("avg(days_of_supply)", 1)} as avg_days_of_supply,
           {r("avg((days_of_supply > 6)::int) * 100", 1)} as excess_stock_pct,
           ifnull(any_value(n), 0)::bigint as stockout_days_last_30, ifnull(any_value(u), 0)::bigint as lost_sales_units_last_30
    from g_inventory join g_product using (sku_id)
    left join (select category, count(*) as n, sum(lost_sales_units_estimate) as u
               from g_stockouts join g_product using (sku_id)
               where stockout_flag and date_key >= (select max(date_key) - 30 from g_stockouts) group by 1) o using (category)
    where location_type = 'Store' and date_key >= (select max(date_key) - 30 from g_inventory)
    group by category""")
final("staging_tests", """
    select 'stg_daily_sales' as model, 'not_null_store_id' as test, (select count(*) from r_daily_sales where store_id is null) as failures
    union all select 'stg_daily_sales', 'not_null_sku_id', (select count(*) from r_daily_sales where sku_id is null)
    union all select 'stg_daily_sales', 'not_null_units_sold', (select count(*) from r_daily_sales where units_sold is null)
    union all select 'stg_daily_sales', 'non_negative_units_sold',
           (select count(*) from r_daily_sales where units_sold >= 0 and units_sold < 0)
    union all select 'stg_inventory_snapshots', 'not_null_location_id', (select count(*) from staged_inventory where location_id is null)
    union all select 'stg_inventory_snapshots', 'not_null_sku_id', (select count(*) from staged_inventory where sku_id is null)""")

final("weekly_demand_panel", "select * from panel",
      "revenue unit_price avg_temp_c precipitation_mm week_sin week_cos rolling_mean_4 rolling_std_4")
final("full_weeks_panel", """
    select week, count(*) as series, sum(units_sold)::bigint as units_sold from panel
    where week >= (select min(date) from r_daily_sales) and week + 6 <= (select max(date) from r_daily_sales) group by 1""")
final("time_split", " union all ".join(
    f"select '{n}' as split, count(*) as row_count, min(week) as first_week, max(week) as last_week, "
    f"sum(units_sold)::bigint as units_sold from {n}" for n in ("train", "test")))
final("moving_average_forecast", "select store_id, sku_id, week, units_sold, forecast_units from baseline", "forecast_units")
final("moving_average_accuracy", f"""
    select {r(wmape("units_sold", "forecast_units"), 4)} as wmape,
           {r("avg(abs((units_sold - forecast_units) / nullif(units_sold, 0))) filter (where units_sold <> 0)", 4)} as mape,
           {r("avg(forecast_units - units_sold) / avg(units_sold)", 4)} as bias,
           {r(f"(1 - {wmape('units_sold', 'forecast_units')}) * 100", 2)} as accuracy_pct
    from baseline""")
final("series_mean_feature", """
    select store_id, sku_id, week, ifnull(m, (select avg(units_sold) from train)) as combo_mean_hist
    from test left join (select store_id, sku_id, avg(units_sold) as m from train group by 1, 2) x using (store_id, sku_id)""",
      "combo_mean_hist")
final("smoothing_forecast", "select * from smoothing", "forecast_units")
final("smoothing_accuracy", f"""
    select {r(wmape("actual_units", "forecast_units"), 4)} as wmape,
           {r("avg(abs((actual_units - forecast_units) / nullif(actual_units, 0))) filter (where actual_units <> 0)", 4)} as mape,
           {r("avg(forecast_units - actual_units) / avg(actual_units)", 4)} as bias,
           {r(f"(1 - {wmape('actual_units', 'forecast_units')}) * 100", 2)} as accuracy_pct
    from smoothing""")
final("forecast_comparison", """
    select store_id, sku_id, week, units_sold, forecast_units_advanced, forecast_units_baseline from comparison""",
      "forecast_units_advanced forecast_units_baseline")
final("relative_improvement", f"""
    select b as baseline_wmape, a as advanced_wmape, {r("(b - a) / b * 100", 2)} as relative_improvement_pct
    from (select {r(wmape("units_sold", "forecast_units_baseline"), 4)} as b,
                 {r(wmape("units_sold", "forecast_units_advanced"), 4)} as a from comparison) x""")
ALL_LEVELS, UPPER = ("Store-SKU", "SKU", "Category", "Total"), ("SKU", "Category", "Total")
final("reconcile_baseline", by_level("baseline", "Baseline (4-week moving average)", ALL_LEVELS))
final("reconcile_top_down", by_level("split_rows", "Top-down (ETS share)", UPPER))
final("reconcile_top_down_every_pair", by_level("pair_rows", "Top-down (ETS share)", UPPER))
final("reconcile_top_down_training_share", by_level("split_train_rows", "Top-down (ETS share)", UPPER))

LEAD = "quoted_lead_time_days observed_avg_lead_time_days observed_std_lead_time_days on_time_rate"
RECS = ("demand_mean_daily demand_std_daily lead_time_days lead_time_std_days service_level_z safety_stock_units "
        "reorder_point_units economic_order_qty_units supplier_on_time_rate")  # fmt: skip
REQUEST = "on_hand_units on_order_units days_of_supply reorder_point_units request_qty"
final("lead_time_statistics", "select * from r_lead_times", LEAD)
final("demand_statistics", "select * from demand", "demand_mean demand_std")
final("reorder_recommendations", "select * from recs", RECS)
final("reorder_recommendations_by_category", recommendations(
    "case when category in ('PROMO', 'SMALL') then 1.88::double else 1.28::double end", "unit_cost"), RECS)
FINAL["reorder_recommendations_from_level_file"] = FINAL["reorder_recommendations_by_category"]
final("scenario_summary", f"""
    select scenario, demand_shock_pct, lead_time_shock_pct, {r("avg(safety_stock_units)", 1)} as avg_safety_stock_units,
           {r("avg(reorder_point_units)", 1)} as avg_reorder_point_units,
           round(sum(safety_stock_units::decimal(28,1)), 0)::double as total_safety_stock_units
    from ({shocked("demand_shock_pct", "lead_time_shock_pct", "cased")}) x group by 1, 2, 3""")
final("scenario_shock", f"select * exclude (m, s, t, u, ss) from ({shocked('0.25::double', '0.3::double', 'recs')}) x", RECS)
final("replenishment_requests", "select * from requests where request_qty > 0", REQUEST)
final("reorder_queue", "select * from requests where request_qty > 0", REQUEST)
final("warehouse_allocation", """
    select warehouse_id, sku_id, store_id, request_qty, fill as fill_ratio, request_qty * fill as approved_qty,
           case when fill >= 0.98 then 'System Auto-Replenishment' else 'Planner Review' end as approver,
           fill < 0.98 as override_flag,
           case when fill >= 0.98 then '' else 'Warehouse supply shortfall - partial fulfilment' end as override_reason,
           case when fill >= 0.98 then 'Auto-approved' else 'Manual override' end as decision_status
    from (select t.warehouse_id, q.sku_id, q.store_id, request_qty,
                 least(1, greatest(ifnull(w.on_hand_units, 0), 0) / sum(request_qty) over (partition by t.warehouse_id, q.sku_id)) as fill
          from requests q join r_stores t using (store_id)
          left join newest w on w.location_type = 'Warehouse' and w.location_id = t.warehouse_id and w.sku_id = q.sku_id
          where request_qty > 0) x""", "request_qty fill_ratio approved_qty")
final("days_of_supply", """
    select date, location_id, sku_id, on_hand_units / greatest(demand_mean, 0.1) as computed_days_of_supply
    from r_inventory_snapshots s join demand d on d.store_id = s.location_id and d.sku_id = s.sku_id""".replace(
    "select date, location_id, sku_id", "select s.date, s.location_id, s.sku_id"), "computed_days_of_supply")
final("lost_sales", f"""
    select date, store_id, sku_id, true as stockout_flag, units_sold - 150 as lost_sales_units_estimate,
           {r("(units_sold - 150) * unit_price", 2)} as lost_sales_revenue_estimate
    from r_daily_sales join r_skus using (sku_id) where units_sold > 150""")

final("promotion_uplift", "select * from uplift",
      "expected_units_baseline uplift_units uplift_pct planned_uplift_pct")
final("promotion_uplift_summary", f"""
    select promo_type, count(*) as events, {r("avg(uplift_pct)", 1)} as avg_uplift_pct,
           {r("avg(planned_uplift_pct)", 1)} as avg_planned_uplift_pct,
           {r("avg(uplift_pct) - avg(planned_uplift_pct)", 1)} as variance_pp from uplift group by 1""")
final("promoted_sales_flag", """
    select date, store_id, sku_id, units_sold,
           exists (select 1 from r_promotions p where p.sku_id = s.sku_id and s.date >= start_date and s.date <= end_date) as on_promotion
    from r_daily_sales s""")
final("uplift_review_queue", """
    select promo_id, uplift_pct, planned_uplift_pct, uplift_pct - planned_uplift_pct as variance_pp from uplift
    where uplift_pct - planned_uplift_pct not between -15 and 15""", "uplift_pct planned_uplift_pct variance_pp")
final("stock_features", "select * from stock_features",
      "on_hand_units on_order_units safety_stock_units days_of_supply dos_rolling_mean dos_rolling_std dos_change")
final("anomalies_by_step", "select * from flagged", "on_hand_units on_order_units days_of_supply anomaly_score")
final("anomaly_types", "select anomaly_type, count(*) as inventory_anomalies from flagged group by 1")
final("order_risk_features", "select * from order_features", "reliability_score")
final("supplier_risk_rollup", """
    select supplier_id, count(*) as orders, avg(is_late) as observed_late_rate, avg(late_risk_score) as avg_predicted_risk,
           any_value(reliability_score) as reliability_score from stated_risk group by 1""",
      "observed_late_rate avg_predicted_risk reliability_score")
final("risk_review_queue", "select po_id, supplier_id, late_risk_score from stated_risk where late_risk_score > 0.3", "late_risk_score")

final("quality_rules", "select * from rules", "threshold")
final("quality_rules_from_file", "select * from rules", "threshold")
final("saved_demand_model_scores", "select week, count(*) as row_count, count(*) as rows_alike from test group by week")
final("quality_by_owner", f"""
    select owner, count(*) as rules, count(*) filter (where not passed) as rules_failing,
           {r("avg(pass_rate)", 4)} as avg_pass_rate from rules group by 1""")
final("quality_status", f"""
    select {r("avg(pass_rate)", 4)} as dq_pass_rate, count(*) filter (where not passed) as dq_rules_failing,
           case when avg(pass_rate) <= 0.93 then 'Critical' when avg(pass_rate) <= 0.97 then 'Warning' else 'Healthy' end as dq_status
    from rules""")
final("master_data_checks", """
    select 'product_id uniqueness' as "check", 'Product master' as domain, n = 0 as passed, n || ' duplicates' as detail
    from (select count(*) - count(distinct product_id) as n from r_products)
    union all select 'sku references known product_id', 'Product master', n = 0, n || ' orphaned SKUs'
    from (select count(*) as n from r_skus where product_id not in (select product_id from r_products))
    union all select 'store references known warehouse_id', 'Location master', n = 0, n || ' orphaned stores'
    from (select count(*) as n from r_stores where warehouse_id not in (select warehouse_id from r_warehouses))
    union all select 'supplier_id uniqueness', 'Supplier master', n = 0, case when n = 0 then 'no duplicates' else 'duplicates found' end
    from (select count(*) - count(distinct supplier_id) as n from r_suppliers)
    union all select 'purchase order references known sku_id', 'Supplier master', n = 0, n || ' purchase orders reference an unknown SKU'
    from (select count(*) as n from r_purchase_orders where sku_id not in (select sku_id from r_skus))""")
final("override_summary", "select * from override_totals")
final("override_reasons", """
    select override_reason, count(*) as decisions from r_replenishment_decisions where override_flag group by 1""")
final("forecast_performance_weekly", "select * from weekly_errors")
final("control_chart", """
    select week, wmape, 0.2::double as warning_bound, 0.28::double as critical_bound, status from weekly_errors""")
final("retrain_weeks", """
    select a.week, a.wmape, (select count(*) from weekly_errors b where b.wmape >= 0.2 and b.week <= a.week
                             and b.week > a.week - 21) >= 3 as retrain
    from weekly_errors a""")
final("late_rate_shift", f"""
    select {r("b", 4)} as late_rate_before, {r("a", 4)} as late_rate_after, abs(a - b) > 0.05 as retrain
    from (select avg(is_late::int) filter (where order_date < '1998-01-01') as b,
                 avg(is_late::int) filter (where order_date >= '1998-01-01') as a from g_orders) x""")
final("category_fallback", f"""
    select store_id, sku_id, week, s.status as category_status,
           case when s.status = 'Critical' then forecast_units_baseline else forecast_units_advanced end as forecast_units
    from comparison join (select category, {band("w", 0.2, 0.28)} as status from (
        select category, {wmape("units_sold", "forecast_units_advanced")} as w from comparison group by 1) x) s using (category)""",
      "forecast_units")
final("demand_drift", "select * from drift")
final("supplier_delivery_status", f"""
    select *, 1 - on_time_rate as late_rate, {band("1 - on_time_rate", 0.2, 0.3)} as status from r_lead_times""",
      LEAD + " late_rate")
final("monitoring_summary", """
    select (select wmape from weekly_errors order by week desc limit 1) as latest_weekly_wmape,
           (select status from weekly_errors order by week desc limit 1) as forecast_status,
           (select max(psi) from drift) as max_feature_psi,
           (select status from drift order by psi desc limit 1) as drift_status,
           (select case when avg(pass_rate) <= 0.93 then 'Critical' when avg(pass_rate) <= 0.97 then 'Warning' else 'Healthy' end
            from rules) as data_quality_status,
           (select auc from stated_auc) as lead_time_risk_model_auc, (select count(*) from flagged) as open_inventory_anomalies,
           0.2::double as wmape_warning, 0.28::double as wmape_critical, 0.1::double as psi_warning, 0.25::double as psi_critical,
           0.97::double as dq_pass_rate_warning, 0.93::double as dq_pass_rate_critical,
           0.2::double as late_delivery_rate_warning, 0.3::double as late_delivery_rate_critical""")
final("business_kpis", "select * from kpis")
final("business_kpis_with_targets", f"""
    select kpis.*, b as forecast_wmape_baseline, a as forecast_wmape_advanced,
           {r("(b - a) / b * 100", 2)} as forecast_accuracy_relative_improvement_pct,
           0.1::double as target_stockout_rate_reduction_low, 0.2::double as target_stockout_rate_reduction_high,
           0.08::double as target_excess_inventory_reduction_low, 0.15::double as target_excess_inventory_reduction_high,
           0.1::double as target_forecast_accuracy_improvement, 0.05::double as target_inventory_turns_improvement,
           0.2::double as target_manual_effort_reduction
    from kpis, (select {r(wmape("units_sold", "forecast_units_baseline"), 4)} as b,
                       {r(wmape("units_sold", "forecast_units_advanced"), 4)} as a from comparison) x""")
final("stated_risk_auc", "select auc from stated_auc")
final("stale_scenarios", """
    select promo_id as scenario, start_date as run_date, (last_day - start_date)::int as age_days
    from r_promotions, (select max(date) as last_day from r_daily_sales) d where last_day - start_date > 90""")
final("critical_failures", "select id, pass_rate, threshold, rows_failed from rules where severity = 'critical' and not passed",
      "pass_rate threshold")
final("gold_layer_late_rows", """
    select date_trunc('month', order_date)::date as load_month, count(*) as row_count,
           sum(quantity_ordered)::double as ordered, sum(quantity_received)::double as received from g_orders group by 1""",
      "ordered received")
final("value_estimate", f"""
    select {r("annual_lost_sales_estimate_aud * 0.1::double", 2)} as recovered_sales_low,
           {r("annual_lost_sales_estimate_aud * 0.2::double", 2)} as recovered_sales_high,
           {r("mean_inventory_value_aud * excess_inventory_rate_baseline * 0.08::double * 0.22::double", 2)} as carrying_cost_saved_low,
           {r("mean_inventory_value_aud * excess_inventory_rate_baseline * 0.15::double * 0.22::double", 2)} as carrying_cost_saved_high,
           24.0::double as planner_hours_freed_per_month, 18720.0::double as planner_value_per_year
    from kpis""")

final("sales_measures", f"""
    select store_id, sum(units_sold)::bigint as units_sold, sum(revenue) as revenue,
           (sum(units_sold) filter (where promo_flag))::bigint as promo_units,
           {ratio("sum(units_sold) filter (where promo_flag)", "sum(units_sold)")} as promo_share
    from g_sales group by 1""", "revenue promo_share")
final("stockout_measures", """
    select (select count(*) from g_sales) as store_sku_days, (select count(*) from g_stockouts where stockout_flag) as stockout_days,
           (select count(*) from g_stockouts where stockout_flag)::double / (select count(*) from g_sales) as stockout_rate""",
      "stockout_rate")
final("lost_sales_measures", """
    select store_id, sum(lost_sales_units_estimate)::bigint as lost_sales_units,
           sum(lost_sales_revenue_estimate) as lost_sales_revenue,
           sum(lost_sales_revenue_estimate) * 365 / (select n from history_days) as annualised_lost_sales
    from g_stockouts group by 1""", "lost_sales_revenue annualised_lost_sales")
final("stock_measures", f"""
    select location_id, avg(days_of_supply) as avg_days_of_supply,
           count(*) filter (where location_type = 'Store' and days_of_supply > 6) as excess_stock_rows,
           count(*) filter (where location_type = 'Store') as store_inventory_rows,
           {ratio("count(*) filter (where location_type = 'Store' and days_of_supply > 6)",
                  "count(*) filter (where location_type = 'Store')")} as excess_inventory_rate
    from g_inventory group by 1""", "avg_days_of_supply excess_inventory_rate")
final("turnover_measures", """
    select category, v as inventory_value, c * 365 / (select n from history_days) as cogs_annualised,
           c * 365 / (select n from history_days) / v as inventory_turns
    from (select category, sum(on_hand_units * unit_cost) as v from g_inventory join g_product using (sku_id) group by 1) i
    left join (select category, sum(units_sold * unit_cost) as c from g_sales join g_product using (sku_id) group by 1) s using (category)""",
      "inventory_value cogs_annualised inventory_turns")
final("order_measures", f"""
    select warehouse_id, count(*) as purchase_orders, count(*) filter (where is_late) as late_purchase_orders,
           avg(quantity_received / nullif(quantity_ordered, 0)) as avg_fill_rate, avg(is_late::int) as late_delivery_rate,
           {watch("avg(is_late::int)")} as supplier_status
    from g_orders group by 1""", "avg_fill_rate late_delivery_rate")
final("decision_measures", """
    select location_type, count(*) as replenishment_decisions,
           count(*) filter (where decision_status = 'Auto-approved') as auto_approved_decisions,
           avg((decision_status = 'Auto-approved')::int) as auto_approved_rate,
           1 - avg((decision_status = 'Auto-approved')::int) as override_rate
    from g_decisions group by 1""", "auto_approved_rate override_rate")


def forecast_by(key: str) -> str:
    return f"""
    select {key}, w as wmape, bias as forecast_bias, (1 - w) * 100 as forecast_accuracy_pct, {band("w", 0.2, 0.28)} as forecast_status
    from (select {key}, {wmape("units_sold", "forecast_units")} as w,
                 avg(forecast_units - units_sold) / avg(units_sold) as bias from baseline group by 1) x"""


FORECAST = "wmape forecast_bias forecast_accuracy_pct"
final("forecast_measures", forecast_by("store_id"), FORECAST)
final("drift_measures", f"select max(psi) as max_feature_psi, {band('max(psi)', 0.1, 0.25)} as drift_status from drift")
DQ_STRICT = "case when avg(pass_rate) < 0.93 then 'Critical' when avg(pass_rate) < 0.97 then 'Warning' else 'Healthy' end"
final("quality_measures", f"""
    select severity, avg(pass_rate) as dq_pass_rate, count(*) filter (where not passed) as dq_rules_failing, {DQ_STRICT} as dq_status
    from rules group by 1""", "dq_pass_rate")
final("promotion_measures", """
    select category, count(*) as promo_events, avg(uplift_pct) as avg_uplift_pct,
           avg(planned_uplift_pct) as avg_planned_uplift_pct,
           avg(uplift_pct) - avg(planned_uplift_pct) as uplift_variance_pp from uplift group by 1""",
      "avg_uplift_pct avg_planned_uplift_pct uplift_variance_pp")
final("units_sold_month_over_month", """
    select m.month, m.units_sold, p.units_sold as units_sold_prior, y.units_sold as units_sold_last_year,
           (m.units_sold - p.units_sold)::double / nullif(p.units_sold, 0) as units_sold_mom_pct
    from monthly m left join monthly p on p.month = (m.month - interval 1 month)::date
    left join monthly y on y.month = (m.month - interval 12 month)::date""", "units_sold_mom_pct")
final("stockout_rate_year_over_year", """
    select m.month, m.stockout_rate, m.stockout_rate - y.stockout_rate as stockout_rate_yoy_delta
    from monthly_stockouts m left join monthly_stockouts y on y.month = (m.month - interval 12 month)::date""",
      "stockout_rate stockout_rate_yoy_delta")
final("period_comparison", """
    select m.month, m.units_sold, m.revenue, p.units_sold as units_sold_prior, p.revenue as revenue_prior,
           y.units_sold as units_sold_last_year, y.revenue as revenue_last_year
    from monthly m left join monthly p on p.month = (m.month - interval 1 month)::date
    left join monthly y on y.month = (m.month - interval 12 month)::date""", "revenue revenue_prior revenue_last_year")
final("selected_kpi", "select 'Excess Inventory Rate' as kpi, excess_inventory_rate_baseline as value from kpis")
final("status_colours", f"""
    select store_id, forecast_status, d as dq_status,
           case when 'Critical' in (forecast_status, d) then '#A23A3A' when 'Warning' in (forecast_status, d) then '#B3791D'
                else '#3F7D5C' end as colour
    from ({forecast_by("store_id")}) f, (select {DQ_STRICT} as d from rules) q""")
final("latest_thirteen_weeks", """
    select date_trunc('week', date_key)::date as week, sum(units_sold)::bigint as units_sold from g_sales
    where date_trunc('week', date_key)::date >= (select date_trunc('week', max(date_key))::date - 84 from g_sales) group by 1""")
final("regional_planner_view", """
    select * from g_stockouts where store_id in (select store_id from g_store where region in ('ASIA', 'EUROPE'))""",
      "lost_sales_revenue_estimate")
final("category_manager_view", """
    select * from g_stockouts where sku_id in (select sku_id from g_product where category in ('ECONOMY', 'PROMO'))""",
      "lost_sales_revenue_estimate")
final("regional_planner_orders", """
    select warehouse_id, count(*) as orders, sum(quantity_ordered) as units from g_orders
    where warehouse_id in (select warehouse_id from r_warehouses where region in ('ASIA', 'EUROPE')) group by 1""", "units")
final("inventory_by_region", """
    select region, location_type, count(*) as row_count, sum(on_hand_units) as on_hand_units
    from (select i.*, coalesce(t.region, w.region) as region from g_inventory i
          left join g_store t on t.store_id = i.location_id left join r_warehouses w on w.warehouse_id = i.location_id) x
    group by 1, 2""", "on_hand_units")

final("stockout_rate_by_region", """
    select region, count(*) as store_sku_days, any_value(n)::bigint as stockout_days, any_value(n)::double / count(*) as stockout_rate
    from g_sales join g_store using (store_id)
    join (select region, count(*) filter (where stockout_flag) as n from g_stockouts join g_store using (store_id) group by 1) o
         using (region) group by 1""", "stockout_rate")
final("inventory_value_by_category", """
    select category, v as inventory_value, v / sum(v) over () as share
    from (select category, sum(on_hand_units * unit_cost) as v from newest_gold join g_product using (sku_id) group by 1) x""",
      "inventory_value share")
final("error_trend", f"""
    select week, {wmape("units_sold", "forecast_units_baseline")} as wmape_baseline,
           {wmape("units_sold", "forecast_units_advanced")} as wmape_advanced from comparison group by 1""",
      "wmape_baseline wmape_advanced")
final("error_by_category", forecast_by("category"), FORECAST)
COVER = "case when {v} < 3 then 'Low' when {v} <= 6 then 'Normal' when {v} <= 9 then 'Elevated' else 'Excess' end"
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
final("cover_heatmap", f"""
    select category, {", ".join(f"avg(days_of_supply) filter (where region = '{n}') as {n.lower().replace(' ', '_')}" for n in REGIONS)},
           avg(days_of_supply) as all_regions, {COVER.format(v="avg(days_of_supply)")} as band
    from g_inventory i join g_product using (sku_id) join g_store t on t.store_id = i.location_id
    where location_type = 'Store' group by 1""", "africa america asia europe middle_east all_regions")
final("cover_band_composition", f"""
    select category, band, n as positions, n::double / sum(n) over (partition by category) as share
    from (select category, {COVER.format(v="days_of_supply")} as band, count(*) as n
          from g_inventory join g_product using (sku_id) where location_type = 'Store' group by 1, 2) x""", "share")
final("stockout_trend", """
    select s.week, s.n as store_sku_days, ifnull(o.n, 0) as stockout_days, ifnull(o.n, 0)::double / s.n as stockout_rate
    from (select date_trunc('week', date_key)::date as week, count(*) as n from g_sales group by 1) s
    left join (select date_trunc('week', date_key)::date as week, count(*) as n from g_stockouts where stockout_flag group by 1) o
         using (week)
    where s.week >= (select date_trunc('week', max(date_key))::date - 84 from g_sales)""", "stockout_rate")
final("at_risk_positions", "select * from positions", "position_units reorder_point_units risk_ratio")
final("risk_by_category", """
    select category, count(*) as positions, count(*) filter (where at_risk) as at_risk_positions,
           avg(at_risk::int) as risk_score from positions join g_product using (sku_id) group by 1""", "risk_score")
final("on_time_by_supplier", """
    select supplier_id, supplier_name, region_of_origin, 1 - late_rate as on_time_rate, avg_actual_lead_time_days,
           reliability_score from performance""", "on_time_rate avg_actual_lead_time_days reliability_score")
final("late_trend", """
    select date_trunc('week', order_date)::date as week, count(*) as purchase_orders,
           count(*) filter (where is_late) as late_purchase_orders, avg(is_late::int) as late_delivery_rate
    from g_orders where date_trunc('week', order_date)::date >= (select date_trunc('week', max(order_date))::date - 84 from g_orders)
    group by 1""", "late_delivery_rate")
final("promotion_mix", """
    select category, count(*) as events, count(*)::double / (select count(*) from uplift) as share from uplift group by 1""", "share")
final("variance_trend", f"""
    select date_trunc('month', start_date)::date as month, promo_type,
           {r("avg(uplift_pct - planned_uplift_pct)", 4)} as variance_pp, count(*) as events from uplift group by 1, 2""")


def _needed(sql: str, seen: dict[str, None]) -> None:
    """Steps a text refers to, each after the steps it refers to itself."""
    for name in STEPS:
        if name not in seen and re.search(rf"\b(from|join|,)\s+\(?{name}\b", sql):
            mark = STEPS[name]
            _needed(mark.replace(f"from {name} ", "from ") if name == "fold" else mark, seen)
            seen[name] = None


def build(name: str) -> str:
    sql, doubles = FINAL[name]
    seen: dict[str, None] = {}
    _needed(sql, seen)
    shown = ", ".join(f"{r(c, 4)} as {c}" for c in doubles.split())
    body = f"select * replace ({shown}) from ({sql}) as result" if shown else sql
    steps = ",\n".join(f"{n} as ({STEPS[n]})" for n in seen)
    return f"with recursive {steps}\n{body}" if steps else body


ORACLE: dict[str, str] = {name: build(name) for name in FINAL}
