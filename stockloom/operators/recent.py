"""The newest days of a fact, asked for in a way that skips the month folders of a written layer that lie before them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.sources.tables import MONTH


def newest_month(df: DataFrame) -> DataFrame:
    """The rows that can hold the newest date: the last month folder, or all rows of a table without such folders."""
    if MONTH not in df.columns:
        return df
    return df.where(F.col(MONTH) == df.agg(F.max(MONTH).alias("m")).scalar())


def since(df: DataFrame, date: str, start: Column, inclusive: bool = True) -> DataFrame:
    """Rows from ``start`` on (or after it), a scalar subquery."""
    rows = df.where((F.col(date) >= start) if inclusive else (F.col(date) > start))
    return rows.where(F.col(MONTH) >= F.trunc(start, "month")) if MONTH in df.columns else rows
