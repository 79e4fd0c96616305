"""Reading raw extracts and writing layers, exports, seeds and models."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockloom.functions.columns import month_start
from stockloom.sources.durable import drop_folder, drop_tables, durable, shuffles_dropped
from stockloom.sources.schemas import PARTITION_DATES, RAW_SCHEMAS, SERVICE_LEVEL_SCHEMA

MONTH = "load_month"
MERGED_ROWS = 10_000_000  # rows of the months that are merged in one step


def read_raw(
    spark: SparkSession, folder: str, names: Iterable[str] | None = None, fmt: str = "csv"
) -> dict[str, DataFrame]:
    """Raw extracts ``folder/<name>.<fmt>`` (a file or a folder of files), with the declared schemas."""
    chosen = list(names) if names is not None else list(RAW_SCHEMAS)
    frames = {}
    for name in chosen:
        reader = spark.read.schema(RAW_SCHEMAS[name])
        if fmt == "csv":
            reader = reader.option("header", True).option("mode", "FAILFAST")
        frames[name] = reader.format(fmt).load(f"{folder.rstrip('/')}/{name}.{fmt}")
    return frames


def register_views(tables: Mapping[str, DataFrame], layer: str) -> list[str]:
    """Expose a layer to SQL as temporary views ``<layer>_<table>``; nothing is read yet."""
    names = []
    for name, df in tables.items():
        view = f"{layer}_{name}"
        df.createOrReplaceTempView(view)
        names.append(view)
    return names


def write_raw(tables: Mapping[str, DataFrame], folder: str) -> None:
    """One CSV folder per table, headers included, readable by :func:`read_raw`."""
    for name, df in tables.items():
        flat_csv(df).write.mode("overwrite").option("header", True).csv(f"{folder.rstrip('/')}/{name}.csv")


def write_layer(tables: Mapping[str, DataFrame], folder: str, layer: str) -> None:
    """Replace the tables of a layer with Parquet; facts are partitioned by month so date filters skip folders."""
    for name, df in tables.items():
        path = f"{folder.rstrip('/')}/{layer}/{name}"
        date = PARTITION_DATES.get(name)
        with shuffles_dropped(df.sparkSession):
            if date is None:
                df.write.mode("overwrite").parquet(path)
            else:
                # Rows of a month are brought together for few files; the adaptive rebalance splits a month that is too large.
                out = df.withColumn(MONTH, month_start(date)).hint("rebalance", F.col(MONTH))
                out.write.mode("overwrite").partitionBy(MONTH).parquet(path)


def replace_months(df: DataFrame, folder: str, layer: str, name: str) -> None:
    """Write a fact so that only the months ``df`` has rows in are replaced; all other month folders stay as they are."""
    out = df.withColumn(MONTH, month_start(PARTITION_DATES[name])).hint("rebalance", F.col(MONTH))
    path = f"{folder.rstrip('/')}/{layer}/{name}"
    with shuffles_dropped(df.sparkSession):
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)


def merge_months(df: DataFrame, folder: str, layer: str, name: str, keys: list[str]) -> None:
    """Merge late or corrected rows into a written fact: a row takes the place of the stored rows with its keys.

    Months are rewritten only if they get a row or lose one, as a correction may move a row to another month. The keys are
    looked up in all months, whole rows are read from the touched ones only. The touched months (as many as the calendar
    has) and their numbers of rows are all that reaches the driver. Rows with a null in their keys replace nothing. Rows of
    ``df`` that share their keys all stay. Months are merged in steps of some ``MERGED_ROWS`` rows, so that no more than these
    are moved and held twice at a time; the merged months of a step are written aside before they replace the old ones.
    """
    spark = df.sparkSession
    path = f"{folder.rstrip('/')}/{layer}/{name}"
    label = name.replace("_", "-")
    stored = spark.read.parquet(path)
    late = durable(df.select(*[c for c in stored.columns if c != MONTH]), f"late-{label}")
    new = late.withColumn(MONTH, month_start(PARTITION_DATES[name]))
    replaced = stored.select(*keys, MONTH).join(late.select(*keys).distinct(), keys, "left_semi")
    replaced = durable(replaced, f"replaced-{label}")
    with shuffles_dropped(spark):
        rows = {r[MONTH]: r["rows"] for r in stored.groupBy(MONTH).agg(F.count("*").alias("rows")).collect()}
        added = {r[MONTH]: r["rows"] for r in new.groupBy(MONTH).agg(F.count("*").alias("rows")).collect()}
        lost = {r[MONTH] for r in replaced.select(MONTH).distinct().collect()}
    touched = sorted(added.keys() | lost, key=lambda m: (m is None, m))
    for months in _steps([(m, rows.get(m, 0) + added.get(m, 0)) for m in touched]):
        here = F.col(MONTH).isin([m for m in months if m is not None])
        if None in months:
            here = here | F.col(MONTH).isNull()
        kept = stored.where(here).join(replaced.where(here).select(*keys).distinct(), keys, "left_anti")
        merged = durable(kept.drop(MONTH).unionByName(new.where(here).drop(MONTH)), f"merged-{label}")
        replace_months(merged, folder, layer, name)
        with shuffles_dropped(spark):
            filled = {r[MONTH] for r in merged.select(month_start(PARTITION_DATES[name]).alias(MONTH)).distinct().collect()}
        for month in set(months) - filled:
            drop_folder(spark, f"{path}/{MONTH}={'__HIVE_DEFAULT_PARTITION__' if month is None else month}")
        drop_tables(merged)
    drop_tables(late, replaced)


def _steps(months: list[tuple]) -> list[list]:
    """Neighbouring months with up to ``MERGED_ROWS`` rows together; a larger month is a step of its own."""
    steps, size = [], 0
    for month, rows in months:
        if not steps or size + rows > MERGED_ROWS:
            steps.append([])
            size = 0
        steps[-1].append(month)
        size += rows
    return steps


def read_layer(spark: SparkSession, folder: str, layer: str, names: Iterable[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{folder.rstrip('/')}/{layer}/{n}") for n in names}


def flat_csv(df: DataFrame) -> DataFrame:
    """CSV holds scalars only: nested columns become JSON text."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(
        *[
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def export_datasets(datasets: Mapping[str, DataFrame], folder: str, fmt: str = "csv") -> None:
    """Reporting datasets, one folder each."""
    for name, df in datasets.items():
        path = f"{folder.rstrip('/')}/{name}"
        if fmt == "csv":
            flat_csv(df).write.mode("overwrite").option("header", True).csv(path)
        else:
            df.write.mode("overwrite").format(fmt).save(path)


def write_summary(summary: DataFrame, path: str) -> None:
    """The one-row run summary as nested JSON, in one file."""
    summary.coalesce(1).write.mode("overwrite").json(path)


def read_service_levels(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SERVICE_LEVEL_SCHEMA).option("header", True).csv(path)


def service_level_seed(spark: SparkSession) -> DataFrame:
    """Target service level by category (fixed values) and the reason for it."""
    rows = [
        ("Beverages", 0.95, "sells daily"),
        ("Snacks", 0.95, "sells daily"),
        ("Dairy", 0.97, "keeps for days only"),
        ("Household", 0.90, "can wait for the next delivery"),
        ("Personal Care", 0.90, "can wait for the next delivery"),
        ("Frozen", 0.95, "sells daily"),
    ]
    return spark.createDataFrame(rows, SERVICE_LEVEL_SCHEMA)


def row_counts(tables: Mapping[str, DataFrame], layer: str) -> DataFrame:
    """Rows per table of a layer."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count"
        )
        out = one if out is None else out.unionByName(one)
    return out
