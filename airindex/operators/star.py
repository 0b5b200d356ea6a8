"""Dimensions and the star-shaped report (fact joined to date and location)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airindex.functions.dates import date_id, iso_day_of_week

REPORT_COLUMNS = (
    "measure_date", "year", "month", "day_name", "day_of_week", "city_name", "vn_aqi",
    "health_implication", "dominant_pollutant", "is_hazardous", "data_quality_status",
    "avg_aqi_owm", "avg_pm2_5", "max_pm2_5", "avg_pm10", "max_pm10", "avg_co", "avg_no2",
    "avg_so2", "avg_o3", "avg_no", "avg_nh3", "record_count",
)


def _calendar(days: DataFrame) -> DataFrame:
    d = F.col("measure_date")
    return days.select(date_id(d).alias("date_id"), d,
                       F.year(d).alias("year"), F.month(d).alias("month"),
                       F.date_format(d, "EEEE").alias("day_name"),
                       iso_day_of_week(d).alias("day_of_week"))


def dim_date(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """Calendar rows for ``[start, end]`` (one per day)."""
    n = (end - start).days + 1
    days = spark.range(n).select(F.date_add(F.lit(start), F.col("id").cast("int"))
                                 .alias("measure_date"))
    return _calendar(days)


def dim_date_spanning(df: DataFrame, day: str = "measure_date") -> DataFrame:
    """Calendar covering the span of ``df[day]`` (one scalar subquery for both ends)."""
    span = df.agg(F.struct(F.min(day).alias("first"), F.max(day).alias("last")).alias("span")).scalar()
    days = df.sparkSession.range(1).select(F.explode(F.sequence(span["first"], span["last"])).alias("measure_date"))
    return _calendar(days)


def star_join(fact: DataFrame, dims) -> DataFrame:
    """Inner-join a fact to each ``(dimension, keys)`` in turn.

    No join hint: the planner broadcasts a dimension when its (runtime) size is
    under the broadcast threshold and shuffles both sides otherwise, so a
    dimension that grows with the data is never forced through a broadcast.
    """
    out = fact
    for dim, keys in dims:
        out = out.join(dim, list(keys) if isinstance(keys, (list, tuple)) else keys, "inner")
    return out


def star_report(fact: DataFrame, dates: DataFrame, locations: DataFrame,
                order: bool = True) -> DataFrame:
    """Fact joined to its date and location dimensions, in report column order.

    Inner joins: a fact row without a dimension row drops out. Dimensions are
    small, so the planner broadcasts them when their (runtime) size is under the
    broadcast threshold and shuffles otherwise. ``order`` sorts by date and
    location (a range-partitioned global sort, not a single task).
    """
    f = fact.withColumnRenamed("avg_aqi", "avg_aqi_owm").drop("measure_date")
    out = star_join(f, [(dates, "date_id"),
                        (locations.select("location_id", "city_name"), "location_id")])
    if order:
        out = out.orderBy("measure_date", "location_id")
    return out.select(*REPORT_COLUMNS)
