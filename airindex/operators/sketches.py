"""Mergeable quantiles: a small sketch per day, stored, and merged over any range of days.

An exact quantile of a range needs every value of the range again. A sketch (KLL) of a day is a few
kilobytes whatever the day's volume; sketches of days merge into one of the range whose quantiles have the
same error in rank (about 1.3 % at the default size, less with a larger ``k``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airindex.sinks.files import write_partitioned

K = 200


def day_sketches(df: DataFrame, value: str, keys: Sequence[str] = ("location_id",), day: str = "measure_date", k: int = K) -> DataFrame:
    """keys, day, n, sketch: the values of each group and day (NULLs left out), combined map-side."""
    seen = df.filter(F.col(value).isNotNull())
    return seen.groupBy(*keys, day).agg(F.count(value).alias("n"), F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("sketch"))


def store_sketches(sketches: DataFrame, path: str, day: str = "measure_date") -> None:
    """Write day sketches partitioned by day; a day that is written again replaces itself."""
    write_partitioned(sketches, path, day)


def merged(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """by, n, sketch: one sketch per group of day sketches."""
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def quantile(sketch: str | Column, q: float) -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.lit(float(q)))


def rank_of(sketch: str | Column, value: str | Column) -> Column:
    """Share of the sketched values at or below ``value``."""
    return F.kll_sketch_get_rank_double(sketch, value)
