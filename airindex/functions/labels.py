"""Label and quality-gate Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Source level (1..5) -> label; anything else is "Unknown".
LEVEL_LABELS = ((1, "Good"), (2, "Fair"), (3, "Moderate"), (4, "Poor"), (5, "Very Poor"))
UNKNOWN_LEVEL = "Unknown"

# Health label by upper index bound (inclusive); above the last is "Hazardous".
HEALTH_BANDS = ((50, "Good"), (100, "Moderate"), (150, "Poor"), (200, "Unhealthy"),
                (300, "Very Unhealthy"))
HEALTH_TOP = "Hazardous"
HEALTH_NULL = "N/A"
HAZARD_ABOVE = 200

# Quality gate. 18 of 24 hourly readings (75 %) and some PM mean.
MIN_RECORDS = 18
HOURS_PER_DAY = 24
STATUS_VALID = "Valid"
STATUS_MISSING_PM = "Missing PM Data"
STATUS_INSUFFICIENT = "Insufficient Data (<75%)"


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def level_label(level: Column | str) -> Column:
    level = _col(level)
    chain = None
    for value, label in LEVEL_LABELS:
        cond = level == F.lit(value)
        chain = F.when(cond, F.lit(label)) if chain is None else chain.when(cond, F.lit(label))
    return chain.otherwise(F.lit(UNKNOWN_LEVEL))


def health_label(index: Column | str) -> Column:
    index = _col(index)
    chain = F.when(index.isNull(), F.lit(HEALTH_NULL))
    for bound, label in HEALTH_BANDS:
        chain = chain.when(index <= F.lit(bound), F.lit(label))
    return chain.otherwise(F.lit(HEALTH_TOP))


def is_hazardous(index: Column | str) -> Column:
    """True above the hazard bound; NULL index gives False."""
    return F.coalesce(_col(index) > F.lit(HAZARD_ABOVE), F.lit(False))


def is_valid_day(record_count: Column | str, *pm_means: Column | str) -> Column:
    """Enough readings and at least one PM mean present (never NULL)."""
    any_pm = F.lit(False)
    for pm in pm_means:
        any_pm = any_pm | _col(pm).isNotNull()
    return F.coalesce(_col(record_count) >= F.lit(MIN_RECORDS), F.lit(False)) & any_pm


def quality_status(record_count: Column | str, *pm_means: Column | str) -> Column:
    """``Valid``; else ``Missing PM Data`` when every PM mean is NULL; else insufficient."""
    all_pm_missing = F.lit(True)
    for pm in pm_means:
        all_pm_missing = all_pm_missing & _col(pm).isNull()
    return (F.when(is_valid_day(record_count, *pm_means), F.lit(STATUS_VALID))
            .when(all_pm_missing, F.lit(STATUS_MISSING_PM))
            .otherwise(F.lit(STATUS_INSUFFICIENT)))
