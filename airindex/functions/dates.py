"""Date, time and small scalar Column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def epoch_to_timestamp(epoch_seconds: Column | str) -> Column:
    """Epoch seconds -> timestamp without a string round trip (UTC instant)."""
    return F.timestamp_seconds(_col(epoch_seconds))


def to_epoch(ts: Column | str) -> Column:
    return F.unix_timestamp(_col(ts))


def date_parts(date: Column | str) -> dict[str, Column]:
    """Zero-padded year / month / day strings of a date."""
    date = _col(date)
    return {
        "measure_year": F.date_format(date, "yyyy"),
        "measure_month": F.date_format(date, "MM"),
        "measure_day": F.date_format(date, "dd"),
    }


def date_id(date: Column | str) -> Column:
    """yyyyMMdd as an int, by arithmetic rather than formatting."""
    date = _col(date)
    return (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("int")


def iso_day_of_week(date: Column | str) -> Column:
    """ISO day of week: 1 = Monday ... 7 = Sunday."""
    return (F.weekday(_col(date)) + 1).cast("int")


def day_end_epoch(day_start_epoch: Column | str) -> Column:
    """Last second of the UTC day that starts at ``day_start_epoch``."""
    return _col(day_start_epoch) + F.lit(86400 - 1)


def slug(name: Column | str) -> Column:
    """Lower-case name with spaces replaced by underscores."""
    return F.replace(F.lower(_col(name)), F.lit(" "), F.lit("_"))


def clip_at_zero(x: Column | str) -> Column:
    """max(x, 0) that keeps NULL as NULL."""
    x = _col(x)
    return F.when(x.isNull(), x).otherwise(F.greatest(x, F.lit(0.0)))


def mask_above(x: Column | str, threshold: Column | str) -> Column:
    """x, or NULL where x is above the threshold."""
    x = _col(x)
    return F.when(x <= _col(threshold), x)


def is_process_date(day: Column | str) -> Column:
    """Whether a text is a day as jobs take it: ``yyyy-mm-dd`` and a day of the calendar."""
    day = F.col(day) if isinstance(day, str) else day
    return F.coalesce(day.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$")
                      & F.try_to_timestamp(day, F.lit("yyyy-MM-dd")).isNotNull(), F.lit(False))
