"""The 17 raw retail tables, derived from the order-processing tables of the test data.

Every row of the source tables takes part. Known defects are left in on purpose (missing revenue, rows loaded twice,
negative stock, orders for unregistered SKUs, missing product cost, a rainless data gap), because cleaning and quality
rules have to find them.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom.operators.inventory import lead_time_statistics
from stockloom.sources.schemas import RAW_SCHEMAS, SOURCE_SCHEMAS

# Fixed values of the mapping.
PART_TYPES = "array('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD')"
PROMO_TYPES = "array('BOGO', 'Feature Display', 'Multi-buy', 'Percent Off')"
PROMO_PLANS = "array(75D, 15D, 40D, 25D)"
QUOTED_DAYS = "map('1-URGENT', 30, '2-HIGH', 45, '3-MEDIUM', 60, '4-NOT SPECIFIED', 75, '5-LOW', 90)"
HOLIDAYS = (
    "stack(3, 1, 1, 'New Year', 'High', 4, 25, 'Spring Day', 'Low', 12, 25, 'Midwinter Day', 'High') "
    "as (m, d, name, impact)"
)
UNITS_PER_CASE = 4

BAND = "cast(floor((p_size - 1) / 10) as int)"


def _sku_by_ordinal(ordinal: str) -> str:
    return f"concat(get({PART_TYPES}, cast(({ordinal}) % 6 as int)), '-', ({ordinal}) div 6)"


class RetailTables:
    """Lazy builders, one method per raw table."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._sources: dict[str, DataFrame] = {}

    def source(self, name: str) -> DataFrame:
        """Source table with its declared schema, so that describing a table starts no job."""
        if name not in self._sources:
            reader = self.spark.read.schema(SOURCE_SCHEMAS[name])
            self._sources[name] = reader.parquet(f"{self.folder}/{name}.parquet")
        return self._sources[name]

    # --- master data -------------------------------------------------------------------------------------------

    def products(self) -> DataFrame:
        return (
            self.source("part")
            .groupBy("p_type")
            .agg(F.expr("max(p_retailprice) as price"), F.expr("max(p_size) as size"), F.expr("min(p_brand) as brand"))
            .selectExpr(
                "concat('PROD-', p_type) as product_id",
                "p_type as category",
                "concat(p_type, ' GOODS') as subcategory",
                "brand",
                "if(p_type <> 'PROMO', price * 0.6D, null) as unit_cost",
                "price as unit_price",
                "size * 7 as shelf_life_days",
                "p_type in ('PROMO', 'SMALL') as is_seasonal",
                "date'1994-01-01' as launch_date",
                "false as discontinued",
            )
        )

    def _parts_by_band(self, *aggregates: str) -> DataFrame:
        return (
            self.source("part")
            .groupBy("p_type", F.expr(f"{BAND} as band"))
            .agg(*[F.expr(a) for a in aggregates])
            .selectExpr("*", "concat(p_type, '-', band) as sku_id")
        )

    def skus(self) -> DataFrame:
        return self._parts_by_band("max(p_retailprice) as price", "min(p_partkey) as first_part").selectExpr(
            "sku_id",
            "concat('PROD-', p_type) as product_id",
            "p_type as category",
            "concat(p_type, ' GOODS') as subcategory",
            "concat('BAND-', band) as pack_size",
            "'EA' as uom",
            "cast(first_part as string) as barcode",
            "price * 0.6D as unit_cost",
            "price as unit_price",
            f"{UNITS_PER_CASE} as case_pack_qty",
            "false as discontinued",
        )

    def stores(self) -> DataFrame:
        return self.source("region").selectExpr(
            "concat('STR-', r_regionkey) as store_id",
            "r_name as region",
            "concat('WH-', r_regionkey) as warehouse_id",
            "case when r_regionkey <= 1 then 'Metro' when r_regionkey <= 3 then 'Regional' else 'Express' end "
            "as store_format",
            "500D + r_regionkey * 250 as size_sqm",
            "date'1990-01-01' as open_date",
        )

    def warehouses(self) -> DataFrame:
        return self.source("region").selectExpr(
            "concat('WH-', r_regionkey) as warehouse_id",
            "r_name as region",
            "'Regional' as warehouse_type",
            "100000 + r_regionkey * 20000 as capacity_units",
        )

    def _supplier_regions(self, *columns: str) -> DataFrame:
        nations = self.source("nation").select("n_nationkey", "n_regionkey")
        return self.source("supplier").join(nations, F.expr("s_nationkey = n_nationkey")).select(*columns)

    def suppliers(self) -> DataFrame:
        return (
            self._supplier_regions("s_suppkey", "s_name", "s_acctbal", "n_regionkey")
            .join(self.source("region"), F.expr("n_regionkey = r_regionkey"))
            .selectExpr(
                "concat('SUP-', s_suppkey) as supplier_id",
                "s_name as supplier_name",
                f"get({PART_TYPES}, cast(s_suppkey % 6 as int)) as primary_category",
                "r_name as region_of_origin",
                "least(0.99D, greatest(0.5D, 0.7D + s_acctbal / 40000)) as reliability_score",
                "date'1993-01-01' as onboarding_date",
            )
        )

    # --- movements ---------------------------------------------------------------------------------------------

    def _per_cell(self, condition: str, *aggregates: str) -> DataFrame:
        """Order lines per day, store (region of the supplier) and SKU.

        Grouping runs on the short source keys; identifiers are spelled out once per cell afterwards.
        """
        parts = self.source("part").selectExpr("p_partkey", "p_type", f"{BAND} as band")
        return (
            self.source("lineitem")
            .where(condition)
            .join(self._supplier_regions("s_suppkey", "n_regionkey"), F.expr("l_suppkey = s_suppkey"))
            .join(parts, F.expr("l_partkey = p_partkey"))
            .groupBy(F.expr("to_date(l_shipdate) as date"), "n_regionkey", "p_type", "band")
            .agg(*[F.expr(a) for a in aggregates])
            .selectExpr(
                "*", "concat('STR-', n_regionkey) as store_id", "concat(p_type, '-', band) as sku_id"
            )
        )

    def daily_sales(self) -> DataFrame:
        """Units and revenue per day, store and SKU; untaxed cells lost their revenue, some cells were loaded twice."""
        return self._per_cell(
            "true",
            f"cast(sum(l_quantity) * {UNITS_PER_CASE} as bigint) as units_sold",
            # whole cents times whole per cents: an exact sum in any order
            "sum(floor(l_extendedprice * 100 + 0.5D) * floor((1 - l_discount) * 100 + 0.5D)) / 10000 as revenue",
            "max(l_discount >= 0.08) as promo_flag",
            "max(l_tax) as tax",
            "max(l_linenumber) as last_line",
        ).selectExpr(
            "date",
            "store_id",
            "sku_id",
            "units_sold",
            "if(tax > 0, revenue, null) as revenue",
            "promo_flag",
            "explode(if(last_line = 7, array(1, 2), array(1))) as copy",
        ).drop("copy")

    def inventory_snapshots(self) -> DataFrame:
        outer = "event_type in ('error', 'signup')"
        return (
            self.source("events")
            .groupBy(
                F.expr("to_date(ts) as date"),
                F.expr(f"if({outer}, 'Warehouse', 'Store') as location_type"),
                F.expr(f"concat(if({outer}, 'WH-', 'STR-'), (user_id div 30) % 5) as location_id"),
                F.expr(f"{_sku_by_ordinal('user_id % 30')} as sku_id"),
            )
            .agg(
                F.expr("sum(cast(round(value * 100) as bigint)) / (count(*) * 100) as level"),
                F.expr("sum(cast(get_json_object(props, '$.k') as bigint)) / count(*) as on_order_units"),
            )
            .selectExpr(
                "date",
                "location_type",
                "location_id",
                "sku_id",
                "level - 1 as on_hand_units",
                "on_order_units",
                "10D as safety_stock_units",
                "level / 20 as days_of_supply",
            )
        )

    def purchase_orders(self) -> DataFrame:
        """Every order line, delivered 1 to 120 days after the order; one brand was never registered as a SKU.

        Order and shipping dates of the source are independent of each other, so the days between them, in either
        direction, are folded into that span.
        """
        lines = self.source("lineitem").selectExpr(
            "l_orderkey",
            "l_partkey",
            "l_suppkey",
            "l_linenumber",
            "l_quantity",
            "l_extendedprice",
            "l_returnflag",
            "to_date(l_shipdate) as shipped",
        )
        orders = self.source("orders").selectExpr(
            "o_orderkey", "o_custkey", f"{QUOTED_DAYS}[o_orderpriority] as quoted", "to_date(o_orderdate) as ordered"
        )
        parts = self.source("part").selectExpr("p_partkey", "p_type", f"{BAND} as band", "p_brand")
        return (
            lines.join(orders, F.expr("l_orderkey = o_orderkey"))
            .join(parts, F.expr("l_partkey = p_partkey"))
            .selectExpr("*", "date_add(ordered, 1 + pmod(datediff(shipped, ordered), 120)) as delivered")
            .selectExpr(
                "concat_ws('-', 'PO', l_orderkey, l_linenumber, l_partkey, l_suppkey) as po_id",
                "concat('SUP-', l_suppkey) as supplier_id",
                "if(p_brand = 'Brand#13', concat('UNREGISTERED-', p_type), concat(p_type, '-', band)) as sku_id",
                "concat('WH-', o_custkey % 5) as warehouse_id",
                "ordered as order_date",
                "date_add(ordered, quoted) as expected_delivery_date",
                "delivered as actual_delivery_date",
                "l_quantity * 10 as quantity_ordered",
                "l_quantity * if(l_returnflag = 'R', 9, 10) as quantity_received",
                "l_extendedprice / l_quantity * 0.6D as unit_cost",
                "if(delivered > date_add(ordered, quoted), 'Late', 'Received') as status",
            )
        )

    def lead_times(self) -> DataFrame:
        return lead_time_statistics(self.purchase_orders(), self.skus())

    def stock_outs(self) -> DataFrame:
        lost = self._per_cell(
            "l_returnflag = 'R' and l_linestatus = 'O'", "cast(sum(l_quantity) as bigint) as units"
        )
        return lost.join(self.skus().select("sku_id", "unit_price"), "sku_id").selectExpr(
            "date",
            "store_id",
            "sku_id",
            "units >= 10 as stockout_flag",
            "units as lost_sales_units_estimate",
            "units * unit_price as lost_sales_revenue_estimate",
        )

    def replenishment_decisions(self) -> DataFrame:
        return (
            self.source("orders")
            .selectExpr(
                "*",
                "cast(floor(o_totalprice / 1000) as double) as wanted",
                "o_orderstatus = 'P' and o_orderpriority in ('1-URGENT', '2-HIGH') as planner",
                "o_custkey % 7 = 0 as outer",
            )
            .selectExpr(
                "concat('DEC-', o_orderkey) as decision_id",
                "to_date(o_orderdate) as date",
                f"{_sku_by_ordinal('o_orderkey % 30')} as sku_id",
                "if(outer, 'Warehouse', 'Store') as location_type",
                "concat(if(outer, 'WH-', 'STR-'), o_custkey % 5) as location_id",
                "wanted as recommended_order_qty",
                "wanted / 2 as reorder_point",
                "wanted / 4 as safety_stock_units",
                "if(planner, cast(floor(wanted * 0.75D) as double), wanted) as approved_qty",
                "if(planner, 'Planner Review', 'System Auto-Replenishment') as approver",
                "planner as override_flag",
                "if(planner, concat('Priority ', o_orderpriority), '') as override_reason",
                "if(planner, 'Manual override', 'Auto-approved') as decision_status",
            )
        )

    def returns(self) -> DataFrame:
        return self._per_cell(
            "l_returnflag = 'R' and l_linestatus = 'F'", "cast(sum(l_quantity) as bigint) as quantity"
        ).selectExpr(
            "concat_ws('-', 'RET', date, store_id, sku_id) as return_id",
            "date",
            "store_id",
            "sku_id",
            "quantity",
            "'Customer change of mind' as reason",
        )

    def markdowns(self) -> DataFrame:
        return self._per_cell("l_returnflag = 'N' and l_discount >= 0.1D", "count(*) as n").selectExpr(
            "concat_ws('-', 'MKD', date, store_id, sku_id) as markdown_id",
            "sku_id",
            "store_id",
            "date",
            "if(n > 1, 25, 15) as markdown_pct",
            "'Clearance' as reason",
        )

    # --- calendars ---------------------------------------------------------------------------------------------

    def promotions(self) -> DataFrame:
        """One campaign per SKU and year."""
        return (
            self._parts_by_band("count(*) as n")
            .selectExpr(
                "sku_id",
                f"cast(array_position({PART_TYPES}, p_type) as int) - 1 + band * 6 as ordinal",
                "explode(sequence(1996, 2000)) as year",
            )
            .selectExpr("*", "date_add(make_date(year, 1, 1), ordinal * 11) as start_date")
            .selectExpr(
                "concat_ws('-', 'PROMO', ordinal, year) as promo_id",
                "sku_id",
                "start_date",
                "date_add(start_date, 13 - ordinal % 3) as end_date",
                f"get({PROMO_TYPES}, ordinal % 4) as promo_type",
                "10D + ordinal % 3 * 5 as discount_pct",
                f"get({PROMO_PLANS}, ordinal % 4) as planned_uplift_pct",
            )
        )

    def prices(self) -> DataFrame:
        steps = "stack(2, date'1995-01-01', low, date'1998-01-01', high) as (effective_date, list_price)"
        return self._parts_by_band("min(p_retailprice) as low", "max(p_retailprice) as high").selectExpr(
            "sku_id", steps, "'AUD' as currency"
        )

    def _days_by_region(self) -> DataFrame:
        """Every day of the shipping history for every region."""
        days = (
            self.source("lineitem")
            .selectExpr("sequence(to_date(min(l_shipdate)), to_date(max(l_shipdate))) as days")
            .scalar()
        )
        return self.source("region").select("r_regionkey", "r_name", F.explode(days).alias("date"))

    def weather(self) -> DataFrame:
        gap = "r_regionkey = 2 and date between '1996-03-04' and '1996-03-10'"
        return (
            self._days_by_region()
            .selectExpr("*", "dayofyear(date) as day")
            .selectExpr("*", "((day * 7 + r_regionkey * 13) % 30) / 2D as rain")
            .selectExpr(
                "date",
                "r_name as region",
                f"15D + 10 * cos({2 * math.pi}D * (day - 20) / 365) + r_regionkey as avg_temp_c",
                f"if({gap}, null, rain) as precipitation_mm",
                "rain >= 14 as severe_weather_flag",
            )
        )

    def holidays(self) -> DataFrame:
        return (
            self._days_by_region()
            .selectExpr("*", HOLIDAYS)
            .where("month(date) = m and dayofmonth(date) = d and (m <> 4 or r_regionkey % 2 = 0)")
            .selectExpr("date", "name as holiday_name", "r_name as region", "impact as impact_level")
        )

    def tables(self, *names: str) -> dict[str, DataFrame]:
        """The named raw tables, all 17 without names."""
        return {n: getattr(self, n)() for n in (names or RAW_SCHEMAS)}
