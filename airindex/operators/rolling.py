"""Trailing rolling means with a minimum-count rule, partitioned by location-month.

A window with only a location key puts one long series in one task; with no key
at all (as a single-day job can get away with) everything lands in one task.
Here the window runs per ``(location, month bucket)``: each reading belongs to
its own month's bucket, and readings near the end of a month are also copied
into the next month's bucket as a halo. A bucket holds one location-month plus
its halo (at most 744 + 24 hourly rows), whatever the history length, and only
the halo rows (about 3 %) are shuffled twice.

* ``rolling_rows`` (row frame) reproduces a job that reads day D-1 and D and
  keeps D, for every D at once: the previous rows are ``lag`` columns with their
  days, and those from D-1 and D are summed. Those are the newest rows of the frame, so what is
  kept is exactly the last ``rows`` rows of the two-day buffer. The halo is the
  last ``halo_days`` days of each month.
* ``rolling_seconds`` (range frame over epoch seconds) equals a window over the
  whole history; its halo is the last ``seconds`` of each month.

The bucket column stays available (``keep_bucket``) so that a following
aggregation on ``(location, bucket, day)`` reuses the window's partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airindex.functions.exact import SCALE, exact_window_mean, units

BUCKET = "_bucket_month"


def _month(day: Column) -> Column:
    return F.trunc(day, "month")


def with_month_halo(df: DataFrame, day: str = "measure_date", halo=None) -> DataFrame:
    """Assign each row to its month's bucket and, where ``halo`` holds, also to the next."""
    own = _month(F.col(day))
    nxt = F.add_months(own, 1)
    buckets = F.array(own)
    if halo is not None:
        buckets = F.when(halo, F.array(own, nxt)).otherwise(F.array(own))
    return df.withColumn(BUCKET, F.explode(buckets))


def _own_bucket(day: str) -> Column:
    return _month(F.col(day)) == F.col(BUCKET)


def rolling_rows(df: DataFrame, value: str, rows: int = 8, order: str = "measured_at",
                 partition: Sequence[str] = ("location_id",), day: str = "measure_date",
                 halo_days: int = 1, mean_col: str | None = None,
                 count_col: str | None = None, keep_bucket: bool = False) -> DataFrame:
    """Mean and non-NULL count of ``value`` over the current and ``rows - 1`` previous rows,
    restricted to rows of the current day and the ``halo_days`` days before it.

    Returns ``df`` plus ``mean_col`` / ``count_col`` (default ``rolling_<value>``,
    ``count_<value>``). The mean is an exact integer-unit mean (see ``exact``).
    """
    mean_col = mean_col or f"rolling_{value}"
    count_col = count_col or f"count_{value}"
    d = F.col(day)
    last_of_month = F.date_sub(F.add_months(_month(d), 1), 1)
    halo = d > F.date_sub(last_of_month, halo_days)
    w = Window.partitionBy(*partition, BUCKET).orderBy(order)
    # The rows before, as plain columns over one window: value units and day of each.
    number = F.unix_date(d)
    lagged = {f"_u{i}": F.lag("_u0", i).over(w) for i in range(1, rows)}
    lagged |= {f"_d{i}": F.lag("_d0", i).over(w) for i in range(1, rows)}
    out = (with_month_halo(df, day, halo)
           .withColumns({"_u0": units(value), "_d0": number})
           .withColumns(lagged).filter(_own_bucket(day)))
    # Rows of an earlier day than the halo's first do not count.
    kept = [F.col("_u0")] + [F.when(F.col(f"_d{i}") >= F.col("_d0") - halo_days, F.col(f"_u{i}"))
                             for i in range(1, rows)]
    total = F.lit(0).cast("decimal(38,0)")
    count = F.lit(0).cast("long")
    for u in kept:
        total = (total + F.coalesce(u, F.lit(0).cast("decimal(28,0)"))).cast("decimal(38,0)")
        count = count + u.isNotNull().cast("long")
    out = out.withColumn(count_col, count).withColumn("_total", total.cast("double"))
    out = out.withColumn(mean_col, F.when(F.col(count_col) > 0,
                                          F.col("_total") / (F.col(count_col) * float(10 ** SCALE))))
    out = out.drop("_total", *[f"_{x}{i}" for x in "ud" for i in range(rows)])
    return out if keep_bucket else out.drop(BUCKET)


def rolling_seconds(df: DataFrame, value: str, seconds: int = 8 * 3600,
                    order: str = "measured_at", partition: Sequence[str] = ("location_id",),
                    day: str = "measure_date", mean_col: str | None = None,
                    count_col: str | None = None, keep_bucket: bool = False) -> DataFrame:
    """Mean and count over readings in ``(t - seconds + 1 h .. t]``: a true time window.

    The frame is ``rangeBetween(-(seconds - 3600), 0)`` on epoch seconds, so 8 hours
    of hourly readings means the current hour and the 7 before it.
    """
    if seconds > 28 * 86400:
        raise ValueError("rolling_seconds supports frames shorter than a month")
    mean_col = mean_col or f"rolling_{value}"
    count_col = count_col or f"count_{value}"
    lookback = seconds - 3600
    epoch = F.unix_timestamp(F.col(order))
    next_month_start = F.unix_timestamp(F.add_months(_month(F.col(day)), 1).cast("timestamp"))
    halo = epoch > next_month_start - F.lit(lookback + 1)
    w = (Window.partitionBy(*partition, BUCKET).orderBy(F.col("_epoch"))
         .rangeBetween(-lookback, Window.currentRow))
    out = (with_month_halo(df.withColumn("_epoch", epoch), day, halo)
           .withColumn(count_col, F.count(value).over(w))
           .withColumn(mean_col, exact_window_mean(value, w, count=F.col(count_col)))
           .filter(_own_bucket(day))
           .drop("_epoch"))
    return out if keep_bucket else out.drop(BUCKET)


def rolling_mean(df: DataFrame, value: str, order: str = "measured_at",
                 partition: Sequence[str] = ("location_id",), rows: int | None = 8,
                 seconds: int | None = None, min_count: int | None = None,
                 day: str = "measure_date") -> DataFrame:
    """Trailing mean of ``value`` over ``rows`` rows or ``seconds`` of time.

    Adds ``rolling_<value>`` and ``count_<value>``; with ``min_count`` the mean is
    NULL where fewer non-NULL values were in the frame.
    """
    if seconds is not None:
        out = rolling_seconds(df, value, seconds, order, partition, day)
    else:
        out = rolling_rows(df, value, rows or 8, order, partition, day)
    if min_count is not None:
        mean, count = f"rolling_{value}", f"count_{value}"
        out = out.withColumn(mean, F.when(F.col(count) >= min_count, F.col(mean)))
    return out
