"""Row-based look-back windows over series of any length."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec


def with_lookback(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    values: list[str],
    rows_back: int,
    chunk: Column,
    add: Callable[[WindowSpec], dict[str, Column]],
) -> DataFrame:
    """Window columns that look at most ``rows_back`` rows back, without one task per series.

    A series is cut into chunks (``chunk`` must not decrease along ``order``); each chunk gets the last ``rows_back``
    rows before it as extra rows, the window runs per chunk, and the extra rows are dropped. Results equal the window
    over the whole series, while a series holding a large part of the table is spread over its chunks.

    ``add`` receives the window and returns the new columns; they may use ``values`` only.
    """
    cells = ["_chunk", *keys]
    point = F.struct(*order, *values)
    chunked = df.withColumn("_chunk", chunk)

    newest_first = Window.partitionBy(*cells).orderBy(*[F.col(c).desc() for c in order])
    ends = (
        chunked.select(*cells, *dict.fromkeys([*order, *values]))
        .withColumn("_rank", F.row_number().over(newest_first))
        .where(F.col("_rank") <= rows_back)
        .groupBy(*cells)
        .agg(F.sort_array(F.collect_list(point)).alias("_end"))
    )
    # One row per chunk from here on: every chunk has at least one row, so the last rows_back chunks are enough.
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(-rows_back, -1)
    lead_in = (
        ends.withColumn("_before", F.flatten(F.collect_list("_end").over(earlier)))
        .where(F.size("_before") > 0)
        .withColumn("_p", F.explode(F.slice("_before", -F.least(F.lit(rows_back), F.size("_before")), F.lit(rows_back))))
        .select(*cells, "_p.*", F.lit(True).alias("_extra"))
    )
    spec = Window.partitionBy(*cells).orderBy(*order)
    combined = chunked.withColumn("_extra", F.lit(False)).unionByName(lead_in, allowMissingColumns=True)
    return combined.withColumns(add(spec)).where(~F.col("_extra")).drop("_extra", "_chunk")
