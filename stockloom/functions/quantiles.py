"""Exact quantiles of columns with too many distinct values for one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockloom.sources.durable import durable


def exact_quantile(df: DataFrame, column: str, p: float) -> DataFrame:
    """One row, one column ``value``: the linearly interpolated ``p`` quantile, NULL for no data.

    ``percentile`` keeps every distinct value in one task, which continuous scores do not survive. Here the counts of the
    values are spread over tasks in value order and written once, and only the total of each task is ordered centrally.
    """
    values = df.select(F.lit(0).alias("g"), F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull())
    counts = durable(range_parts(values.groupBy("g", "v").agg(F.count("*").alias("c")), "g", "v"), "value-counts")
    found = quantiles_from_counts(counts, "g", "v", "c", [p])
    return found.agg(F.max(F.col("quantiles")[0]).alias("value"))


def range_parts(counts: DataFrame, group: str, value: str) -> DataFrame:
    """Value counts spread over tasks in value order, with the number of the task as column ``part``.

    Write the result before reading it again: the numbers belong to this one distribution of the rows.
    """
    return counts.repartitionByRange(group, value).withColumn("part", F.spark_partition_id())


def quantiles_from_counts(
    counts: DataFrame, group: str, value: str, weight: str, probabilities: list[float]
) -> DataFrame:
    """Interpolated quantiles per group from value counts of :func:`range_parts`: ``group, rows, quantiles``.

    A running count needs the values in order, but not in one task: each part counts on its own, on top of the total of
    the parts before it. Only one row per part and group is ordered centrally.
    """
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = counts.groupBy(group, "part").agg(F.sum(weight).alias("inside"))
    offsets = totals.select(
        group,
        "part",
        F.coalesce(F.sum("inside").over(before), F.lit(0)).alias("offset"),
        F.sum("inside").over(Window.partitionBy(group)).alias("rows"),
    )
    within = Window.partitionBy(group, "part").orderBy(value)
    running = counts.join(offsets, [group, "part"]).withColumn("upto", F.col("offset") + F.sum(weight).over(within))

    def rank(p: float) -> Column:
        return (F.col("rows") - 1) * F.lit(float(p))

    def at(position: Column) -> Column:
        return F.min(F.when(F.col("upto") > position, F.col(value)))

    ends = running.groupBy(group, "rows").agg(
        *[at(F.floor(rank(p))).alias(f"low_{i}") for i, p in enumerate(probabilities)],
        *[at(F.floor(rank(p)) + 1).alias(f"high_{i}") for i, p in enumerate(probabilities)],
    )

    def between(i: int, p: float) -> Column:
        low, high = F.col(f"low_{i}"), F.coalesce(f"high_{i}", f"low_{i}")
        return low + (rank(p) - F.floor(rank(p))) * (high - low)

    return ends.select(group, "rows", F.array(*[between(i, p) for i, p in enumerate(probabilities)]).alias("quantiles"))
