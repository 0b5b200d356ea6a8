"""Data-quality views over the daily fact: KPIs, issue log, completeness, coverage gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airindex.functions.exact import mean_half_up
from airindex.functions.labels import HOURS_PER_DAY, STATUS_VALID


def kpi_summary(fact: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Mean index, max PM2.5, total / valid / issue days, completeness %: one row, or one
    row per ``by`` group (e.g. per location).

    "Days" are fact rows (location-days). Completeness is 0 when there are none.
    """
    valid = F.count_if(F.col("data_quality_status") == F.lit(STATUS_VALID))
    total = F.count(F.lit(1))
    return fact.groupBy(*by).agg(
        mean_half_up("vn_aqi", 2).alias("avg_vn_aqi"),
        F.max("max_pm2_5").alias("max_pm2_5"),
        total.alias("total_days"),
        valid.alias("valid_days"),
        (total - valid).alias("issue_days"),
        F.when(total > 0, F.round(valid * F.lit(100.0) / total, 2))
        .otherwise(F.lit(0.0)).alias("completeness_pct"))


def high_water_mark(fact: DataFrame) -> DataFrame:
    """Latest day present (sync status)."""
    return fact.agg(F.max("measure_date").alias("synced_through"))


def status_counts(fact: DataFrame) -> DataFrame:
    return fact.groupBy("data_quality_status").agg(F.count(F.lit(1)).alias("days"))


def issue_log(fact: DataFrame) -> DataFrame:
    """Location-days that did not pass the quality gate."""
    return (fact.filter(F.col("data_quality_status") != F.lit(STATUS_VALID))
            .select("location_id", "measure_date", "record_count", "data_quality_status"))


def completeness_by_day(fact: DataFrame) -> DataFrame:
    """Readings per location-day against the expected hourly count."""
    return fact.select("location_id", "measure_date", "record_count", "data_quality_status",
                       F.round(F.col("record_count") / F.lit(float(HOURS_PER_DAY)), 4)
                       .alias("completeness"))


def trend_series(fact: DataFrame) -> DataFrame:
    return fact.select("location_id", "measure_date", "vn_aqi").orderBy("location_id",
                                                                        "measure_date")


def coverage_gaps(readings: DataFrame, locations: DataFrame, start=None, end=None) -> DataFrame:
    """(location, day) pairs with no reading in ``[start, end]`` (default: span of readings).

    Each location row explodes its own expected days (a generator, not a join of
    all pairs); the anti-join against the distinct observed days is a shuffle on
    (location, day).
    """
    if start is None or end is None:
        # One scalar subquery for both ends.
        span = readings.agg(F.struct(F.min("measure_date").alias("first"), F.max("measure_date").alias("last")).alias("span")).scalar()
    first = F.lit(start) if start is not None else span["first"]
    last = F.lit(end) if end is not None else span["last"]
    expected = locations.select("location_id", "city_name",
                                F.explode(F.sequence(first, last)).alias("measure_date"))
    seen = readings.select("location_id", "measure_date").distinct()
    return expected.join(seen, ["location_id", "measure_date"], "left_anti")
