"""Hourly readings -> one row per location-day (partial + final hash aggregate)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airindex.functions.exact import mean_half_up

# A rolling 8-hour ozone mean counts only with at least 6 values.
MIN_8H_VALUES = 6


def _r2(c):
    return F.round(c, 2)


def _mean2(c):
    return mean_half_up(c, 2)


def daily_rollup(readings: DataFrame, keys: Sequence[str] = ("location_id", "measure_date"),
                 rolling: str = "rolling_o3", rolling_count: str = "count_o3") -> DataFrame:
    """Daily means and maxima per key; ``max_8h_o3`` needs the rolling columns.

    Means and gas maxima are rounded to 2 places (HALF_UP); PM maxima are not.
    Means come from exact integer sums, so they do not depend on partitioning.
    ``record_count`` counts readings, whatever their NULLs.
    """
    aggs = [
        _mean2("aqi_level").alias("avg_aqi"),
        F.max("aqi_level").alias("max_aqi"),
        F.min("aqi_level").alias("min_aqi"),
        _mean2("pm2_5").alias("avg_pm2_5"),
        F.max("pm2_5").alias("max_pm2_5"),
        _mean2("pm10").alias("avg_pm10"),
        F.max("pm10").alias("max_pm10"),
        _r2(F.max("co")).alias("max_1h_co"),
        _r2(F.max("no2")).alias("max_1h_no2"),
        _r2(F.max("so2")).alias("max_1h_so2"),
        _r2(F.max("o3")).alias("max_1h_o3"),
    ]
    if rolling in readings.columns:
        aggs.append(_r2(F.max(F.when(F.col(rolling_count) >= F.lit(MIN_8H_VALUES),
                                     F.col(rolling)))).alias("max_8h_o3"))
    aggs += [
        _mean2("co").alias("avg_co"),
        _mean2("no2").alias("avg_no2"),
        _mean2("so2").alias("avg_so2"),
        _mean2("o3").alias("avg_o3"),
        _mean2("no").alias("avg_no"),
        _mean2("nh3").alias("avg_nh3"),
        F.count(F.lit(1)).cast("int").alias("record_count"),
    ]
    return readings.groupBy(*keys).agg(*aggs)
