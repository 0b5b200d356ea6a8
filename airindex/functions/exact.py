"""Deterministic means: exact integer sums and HALF_UP rounding.

A double sum depends on the order in which rows meet in partial aggregates, so a
mean that is mathematically on a half-way point (69.245) can round either way
from one run (or cluster size) to the next. Values are first turned into integer
units of ``10**-scale``; their sum is exact, and the rounded mean is an integer
division. Inputs are assumed to carry at most ``scale`` decimals (sensor values
are reported to 6).

Units are summed as ``decimal(38,0)``: no number of rows overflows it (10^38 units
are 10^32 at scale 6). A single value may be up to 10^22 units in size.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 6


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def units(x: Column | str, scale: int = SCALE) -> Column:
    """x as an exact count of 10**-scale units (decimal(28,0))."""
    return F.round(_col(x) * float(10 ** scale)).cast("decimal(28,0)")


def _wide(x: Column) -> Column:
    return x.cast("decimal(38,0)")


def half_up_div(num: Column, den: Column) -> Column:
    """round(num / den) as a long, half away from zero, for whole decimals with den > 0 (exact)."""
    den = _wide(den)
    q = F.call_function("div", _wide(F.abs(_wide(num)) * 2) + den, den * 2)
    return F.when(num < 0, -q).otherwise(q)


def mean_half_up(x: Column | str, digits: int = 2, scale: int = SCALE) -> Column:
    """Aggregate: mean of x rounded HALF_UP to ``digits`` places; NULL when no values."""
    x = _col(x)
    total = F.sum(units(x, scale))
    n = F.count(x)
    k = half_up_div(_wide(total) * (10 ** digits), _wide(n) * (10 ** scale))
    return F.when(n > 0, k / float(10 ** digits))


def exact_window_mean(x: Column | str, window, scale: int = SCALE,
                      count: Column | None = None) -> Column:
    """Mean over a window frame from an exact integer sum (NULL when no values).

    Pass ``count`` (an already computed ``count(x)`` over the same frame) to
    avoid evaluating it twice.
    """
    x = _col(x)
    n = count if count is not None else F.count(x).over(window)
    total = F.sum(units(x, scale)).over(window).cast("double")
    return F.when(n > F.lit(0), total / (n * F.lit(float(10 ** scale))))


def sum_exact(x: Column | str, scale: int = SCALE) -> Column:
    """Aggregate: exact sum of values with at most ``scale`` decimals, as a double."""
    return F.sum(units(x, scale)).cast("double") / F.lit(float(10 ** scale))
