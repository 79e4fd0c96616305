"""Scalar column helpers: guarded division, rounding, clipping, calendar parts."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(numerator: Column | str, denominator: Column | str) -> Column:
    """Ratio in double precision; NULL when the denominator is zero or NULL."""
    return F.try_divide(col(numerator).cast("double"), col(denominator).cast("double"))


def rounded(value: Column | str, digits: int) -> Column:
    """Half-up rounding to ``digits`` decimals.

    Going through a decimal first makes a tie such as 2.675 a tie, whatever the last bit of the double is, so
    the result does not depend on the order in which a distributed sum was added up.
    """
    return F.round(col(value).cast("decimal(38,8)"), digits).cast("double")


def clip_low(value: Column | str, low: float) -> Column:
    """``greatest`` with a constant; a NULL input becomes the bound."""
    return F.greatest(col(value), F.lit(low))


def as_date(value: Column | str) -> Column:
    return F.to_date(col(value))


def week_start(value: Column | str) -> Column:
    """Monday of the week the date falls in."""
    return F.to_date(F.date_trunc("week", col(value)))


def month_start(value: Column | str) -> Column:
    return F.to_date(F.date_trunc("month", col(value)))


def sunday_based_weekday(value: Column | str) -> Column:
    return F.dayofweek(col(value)) - 1


def iso_date(value: Column | str) -> Column:
    return F.date_format(col(value), "yyyy-MM-dd")


def yearly_phase(week_of_year: Column | str, trig) -> Column:
    """``trig`` (``F.sin`` or ``F.cos``) of the position of the week in a 52-week year."""
    return trig(F.lit(2 * math.pi) * col(week_of_year) / F.lit(52))


def share_true(flag: Column | str) -> Column:
    """Share of rows on which the flag holds; NULL flags count as not holding."""
    return F.avg(F.when(col(flag), 1.0).otherwise(0.0))


def count_true(flag: Column | str) -> Column:
    return F.count_if(F.coalesce(col(flag), F.lit(False)))


def annualised(total: Column, days: Column) -> Column:
    return total * F.lit(365.0) / F.greatest(days, F.lit(1))
