"""Status bands on rates, errors and drift values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockloom.functions.columns import col


@dataclass(frozen=True)
class Thresholds:
    """Alert bounds and policy constants. Fixed values; pass another instance to change policy."""

    wmape_warning: float = 0.20
    wmape_critical: float = 0.28
    psi_warning: float = 0.10
    psi_critical: float = 0.25
    dq_warning: float = 0.97
    dq_critical: float = 0.93
    late_warning: float = 0.20
    late_critical: float = 0.30
    excess_days: float = 6
    volume_outlier_units: int = 200
    service_level_z: float = 1.65
    order_cost: float = 45.0
    holding_rate: float = 0.22
    contamination: float = 0.02
    review_risk: float = 0.30
    review_variance_pp: float = 15.0
    scenario_max_age_days: int = 90
    base_rate_shift: float = 0.05


DEFAULTS = Thresholds()


def status_band(
    value: Column | str,
    warning: float,
    critical: float,
    higher_is_worse: bool = True,
    labels: tuple[str, str, str] = ("Healthy", "Warning", "Critical"),
) -> Column:
    """Three bands with inclusive bounds; a missing value is ``Unknown``."""
    v = col(value).cast("double")
    ok, warn, crit = labels

    def beyond(bound: float) -> Column:
        return (v >= F.lit(bound)) if higher_is_worse else (v <= F.lit(bound))

    return (
        F.when(v.isNull() | F.isnan(v), "Unknown").when(beyond(critical), crit).when(beyond(warning), warn).otherwise(ok)
    )


def wmape_status(value: Column | str, t: Thresholds = DEFAULTS) -> Column:
    return status_band(value, t.wmape_warning, t.wmape_critical)


def drift_status(value: Column | str, t: Thresholds = DEFAULTS) -> Column:
    return status_band(value, t.psi_warning, t.psi_critical)


def pass_rate_status(value: Column | str, t: Thresholds = DEFAULTS) -> Column:
    return status_band(value, t.dq_warning, t.dq_critical, higher_is_worse=False)


def pass_rate_status_strict(value: Column | str, t: Thresholds = DEFAULTS) -> Column:
    """Report variant of the pass-rate band: the bounds themselves belong to the better band."""
    v = col(value)
    return F.when(v < t.dq_critical, "Critical").when(v < t.dq_warning, "Warning").otherwise("Healthy")


def late_rate_status(value: Column | str, t: Thresholds = DEFAULTS) -> Column:
    return status_band(value, t.late_warning, t.late_critical)


def delivery_band(value: Column | str, t: Thresholds = DEFAULTS) -> Column:
    """Scorecard variant of the late-rate band: the middle label is ``Watch`` and NULL counts as healthy."""
    v = col(value)
    return F.when(v >= t.late_critical, "Critical").when(v >= t.late_warning, "Watch").otherwise("Healthy")


def status_colour(*statuses: Column | str) -> Column:
    """Worst status wins. Red, amber and green of the report theme."""

    def any_is(label: str) -> Column:
        hit = F.lit(False)
        for s in statuses:
            hit = hit | (col(s) == label)
        return hit

    return F.when(any_is("Critical"), "#A23A3A").when(any_is("Warning"), "#B3791D").otherwise("#3F7D5C")


def days_of_supply_band(days: Column | str) -> Column:
    """Heat-map bands: under 3 days, 3 to 6, 6 to 9 and above."""
    d = col(days)
    return F.when(d < 3, "Low").when(d <= 6, "Normal").when(d <= 9, "Elevated").when(d > 9, "Excess")
