"""Forecast-accuracy measures as aggregate columns.

``error_sums`` is additive, so it can be computed at a fine grain and summed further up; ``from_error_sums`` turns the
totals into the published measures. The short forms (``wmape`` and so on) are for a single aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockloom.functions.columns import col, rounded, safe_divide

EPSILON = 1e-6
SUM_NAMES = ("abs_err", "abs_act", "err", "act", "ape", "ape_n")


def wmape(actual: Column | str, forecast: Column | str) -> Column:
    a, f = col(actual), col(forecast)
    return safe_divide(F.sum(F.abs(a - f)), F.sum(F.abs(a)))


def mape(actual: Column | str, forecast: Column | str, epsilon: float = EPSILON) -> Column:
    a, f = col(actual), col(forecast)
    return F.avg(F.when(F.abs(a) > epsilon, F.abs(safe_divide(a - f, a))))


def bias(actual: Column | str, forecast: Column | str) -> Column:
    a, f = col(actual), col(forecast)
    return safe_divide(F.avg(f - a), F.avg(a))


def error_sums(actual: Column | str, forecast: Column | str, epsilon: float = EPSILON) -> list[Column]:
    a, f = col(actual).cast("double"), col(forecast).cast("double")
    usable = F.abs(a) > epsilon
    return [
        F.sum(F.abs(a - f)).alias("abs_err"),
        F.sum(F.abs(a)).alias("abs_act"),
        F.sum(f - a).alias("err"),
        F.sum(a).alias("act"),
        F.sum(F.when(usable, F.abs(safe_divide(a - f, a)))).alias("ape"),
        F.count_if(usable).alias("ape_n"),
    ]


def add_up_error_sums() -> list[Column]:
    return [F.sum(n).alias(n) for n in SUM_NAMES]


def from_error_sums() -> list[Column]:
    """wmape, mape and bias on 4 decimals and the accuracy percentage on 2."""
    w = safe_divide("abs_err", "abs_act")
    return [
        rounded(w, 4).alias("wmape"),
        rounded(safe_divide("ape", "ape_n"), 4).alias("mape"),
        rounded(safe_divide("err", "act"), 4).alias("bias"),
        rounded((1 - w) * 100, 2).alias("accuracy_pct"),
    ]
