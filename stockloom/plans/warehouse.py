"""Raw extracts to a checked, written star schema."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom.functions.columns import rounded
from stockloom.operators.gold import build_gold
from stockloom.operators.quality import quality_gate, run_quality_rules
from stockloom.operators.silver import build_silver
from stockloom.sources.tables import read_layer, register_views, row_counts, write_layer


def build_warehouse(
    spark: SparkSession, raw: Mapping[str, DataFrame], folder: str, enforce_gate: bool = False
) -> dict[str, dict[str, DataFrame]]:
    """Write silver and gold as Parquet and return all layers, read back from storage.

    Gold is computed from the written silver tables, so each cleaning step runs once. With ``enforce_gate`` a failed
    critical rule stops the run before gold is written.
    """
    register_views(raw, "bronze")
    silver = build_silver(raw)
    write_layer(silver, folder, "silver")
    silver = read_layer(spark, folder, "silver", silver)
    if enforce_gate:
        quality_gate(run_quality_rules(spark, raw))
    gold = build_gold(silver)
    write_layer(gold, folder, "gold")
    gold = read_layer(spark, folder, "gold", gold)
    register_views(silver, "silver")
    register_views(gold, "gold")
    return {"bronze": dict(raw), "silver": silver, "gold": gold}


def layer_row_counts(layers: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    return reduce(DataFrame.unionByName, [row_counts(tables, layer) for layer, tables in layers.items()])


def reconcile_layers(
    bronze: Mapping[str, DataFrame], silver: Mapping[str, DataFrame], gold: Mapping[str, DataFrame]
) -> DataFrame:
    """Silver never grows beyond bronze, and gold totals equal silver totals.

    Every table is read once for all of its counts and sums.
    """
    facts = {
        "fact_daily_sales": ("daily_sales", ("units_sold", "revenue")),
        "fact_inventory": ("inventory_snapshots", ("on_hand_units",)),
        "fact_purchase_orders": ("purchase_orders", ("quantity_ordered", "quantity_received")),
    }
    summed = {source: columns for source, columns in facts.values()}

    def totals(df: DataFrame, columns: tuple[str, ...]) -> Column:
        sums = [F.coalesce(F.sum(c).cast("double"), F.lit(0.0)).alias(c) for c in columns]
        return df.agg(F.struct(F.count("*").cast("double").alias("rows"), *sums).alias("t")).scalar()

    cleaned = ("skus", "stores", "daily_sales", "inventory_snapshots", "purchase_orders")
    measured = {f"bronze_{n}": totals(bronze[n], ()) for n in cleaned}
    measured |= {f"silver_{n}": totals(silver[n], summed.get(n, ())) for n in cleaned}
    measured |= {f"gold_{n}": totals(gold[n], columns) for n, (_, columns) in facts.items()}

    def line(check: str, left: str, right: str, exact: bool) -> Column:
        a, b = rounded(left, 2), rounded(right, 2)
        return F.struct(
            F.lit(check).alias("check"),
            a.alias("left_value"),
            b.alias("right_value"),
            ((a == b) if exact else (a <= b)).alias("passed"),
        )

    lines = [line(f"silver {n} within bronze", f"silver_{n}.rows", f"bronze_{n}.rows", exact=False) for n in cleaned]
    for fact, (source, columns) in facts.items():
        lines += [
            line(f"gold {fact} {c}", f"gold_{fact}.{c}", f"silver_{source}.{c}", exact=True) for c in ("rows", *columns)
        ]
    spark = gold["fact_daily_sales"].sparkSession
    return spark.range(1).select(*[c.alias(n) for n, c in measured.items()]).select(F.inline(F.array(*lines)))
