"""Quality, KPI and pattern queries over the daily fact and the readings."""

from __future__ import annotations

from itertools import combinations

from airindex.functions.labels import STATUS_VALID
from airindex.operators.patterns import (CORR_DIGITS, pattern_by, pollutant_correlation,
                                         rollup_year_month, share_by)
from airindex.operators.quality import (completeness_by_day, coverage_gaps, high_water_mark,
                                        issue_log, kpi_summary, status_counts, trend_series)
from airindex.plans import oracle as O
from airindex.plans.catalog import register
from airindex.plans.daily import daily_air_index
from airindex.schemas import POLLUTANTS
from airindex.sources.tables import dim_location, reading_days, readings
from pyspark.sql import functions as F


def fact(spark, sf_dir):
    return daily_air_index(readings(spark, sf_dir))


_VALID = f"cast(count_if(data_quality_status = {O.q(STATUS_VALID)}) AS bigint)"


@register("kpi_summary", O.with_fact(f"""
SELECT {O.mean_sql('vn_aqi')} AS avg_vn_aqi, max(max_pm2_5) AS max_pm2_5,
       count(*) AS total_days, {_VALID} AS valid_days, count(*) - {_VALID} AS issue_days,
       CASE WHEN count(*) > 0 THEN {O.rnd(f'{_VALID} * 100.0::double / count(*)', 2)}
            ELSE 0.0 END AS completeness_pct
FROM fact"""))
def q_kpi_summary(spark, sf_dir):
    return kpi_summary(fact(spark, sf_dir))


@register("kpi_by_location", O.with_fact(f"""
SELECT location_id, {O.mean_sql('vn_aqi')} AS avg_vn_aqi, max(max_pm2_5) AS max_pm2_5,
       count(*) AS total_days, {_VALID} AS valid_days, count(*) - {_VALID} AS issue_days,
       CASE WHEN count(*) > 0 THEN {O.rnd(f'{_VALID} * 100.0::double / count(*)', 2)}
            ELSE 0.0 END AS completeness_pct
FROM fact GROUP BY location_id"""))
def q_kpi_by_location(spark, sf_dir):
    return kpi_summary(fact(spark, sf_dir), by=("location_id",))


@register("high_water_mark", O.with_fact("SELECT max(measure_date) AS synced_through FROM fact"))
def q_high_water_mark(spark, sf_dir):
    return high_water_mark(fact(spark, sf_dir))


_P99_COLS = ("vn_aqi", "avg_pm2_5", "max_pm2_5")


@register("quantile_p99", O.with_fact(
    "SELECT location_id, " + ", ".join(
        f"{O.rnd(f'quantile_cont({c}, 0.99)', 6)} AS p99_{c}" for c in _P99_COLS)
    + " FROM fact GROUP BY location_id"))
def q_quantile_p99(spark, sf_dir):
    """Exact 0.99 quantile (linear interpolation) per location."""
    return fact(spark, sf_dir).groupBy("location_id").agg(*[
        F.round(F.percentile(c, 0.99), 6).alias(f"p99_{c}") for c in _P99_COLS])


@register("status_counts", O.with_fact(
    "SELECT data_quality_status, count(*) AS days FROM fact GROUP BY 1"))
def q_status_counts(spark, sf_dir):
    return status_counts(fact(spark, sf_dir))


@register("issue_log", O.with_fact(
    "SELECT location_id, measure_date, record_count, data_quality_status FROM fact "
    f"WHERE data_quality_status <> {O.q(STATUS_VALID)}"))
def q_issue_log(spark, sf_dir):
    return issue_log(fact(spark, sf_dir))


@register("completeness_by_day", O.with_fact(
    "SELECT location_id, measure_date, record_count, data_quality_status, "
    f"{O.rnd('record_count / 24.0::double', 4)} AS completeness FROM fact"))
def q_completeness_by_day(spark, sf_dir):
    return completeness_by_day(fact(spark, sf_dir))


@register("trend_series", O.with_fact("SELECT location_id, measure_date, vn_aqi FROM fact"))
def q_trend_series(spark, sf_dir):
    return trend_series(fact(spark, sf_dir))


@register("coverage_gaps", O.with_fact(f""",
span AS (SELECT min(measure_date) AS s, max(measure_date) AS e FROM readings),
expected AS (SELECT location_id, city_name, cast(g.d AS date) AS measure_date
             FROM dim_location, span, generate_series(span.s, span.e, INTERVAL 1 DAY) AS g(d))
SELECT * FROM expected e WHERE NOT EXISTS (
  SELECT 1 FROM fact f WHERE f.location_id = e.location_id AND f.measure_date = e.measure_date
                         AND f.data_quality_status = {O.q(STATUS_VALID)})"""))
def q_coverage_gaps(spark, sf_dir):
    """Location-days of the readings' span that lack a valid day."""
    valid = fact(spark, sf_dir).filter(F.col("data_quality_status") == STATUS_VALID)
    span = reading_days(spark, sf_dir).agg(F.struct(F.min("measure_date").alias("first"), F.max("measure_date").alias("last")).alias("span")).scalar()
    return coverage_gaps(valid, dim_location(spark, sf_dir), span["first"], span["last"])


@register("pollutant_correlation", O.with_readings("\n UNION ALL ".join(
    f"SELECT {O.q(a)} AS pollutant_a, {O.q(b)} AS pollutant_b, "
    f"{O.rnd(f'corr({a}, {b})', CORR_DIGITS)} AS corr, "
    f"cast(count_if({a} IS NOT NULL AND {b} IS NOT NULL) AS bigint) AS n FROM readings"
    for a, b in combinations(POLLUTANTS, 2))))
def q_pollutant_correlation(spark, sf_dir):
    return pollutant_correlation(readings(spark, sf_dir))


@register("pattern_hour_of_day", O.with_readings(
    f"SELECT location_id, cast(hour(measured_at) AS int) AS hour, {O.mean_sql('pm2_5')} "
    "AS avg_pm2_5, max(pm2_5) AS max_pm2_5, count(pm2_5) AS n FROM readings GROUP BY 1, 2"))
def q_pattern_hour_of_day(spark, sf_dir):
    return pattern_by(readings(spark, sf_dir), "hour", "pm2_5", by=("location_id",))


@register("pattern_weekday", O.with_fact(
    f"SELECT cast(isodow(measure_date) AS int) AS weekday, {O.mean_sql('vn_aqi')} AS avg_vn_aqi, "
    "max(vn_aqi) AS max_vn_aqi, count(vn_aqi) AS n FROM fact GROUP BY 1"))
def q_pattern_weekday(spark, sf_dir):
    return pattern_by(fact(spark, sf_dir), "weekday", "vn_aqi", ts="measure_date")


@register("rollup_year_month", O.with_fact(f"""
SELECT year, month, {O.mean_sql('vn_aqi')} AS avg_vn_aqi, count(*) AS days,
       grouping_id(year, month) AS level
FROM (SELECT cast(year(measure_date) AS int) AS year, cast(month(measure_date) AS int) AS month,
             vn_aqi FROM fact)
GROUP BY ROLLUP (year, month)"""))
def q_rollup_year_month(spark, sf_dir):
    return rollup_year_month(fact(spark, sf_dir))


def _share_sql(col: str) -> str:
    return O.with_fact(
        f"SELECT {col}, count(*) AS days, "
        f"{O.rnd('count(*) / (SELECT count(*) FROM fact)::double', 4)} AS share "
        f"FROM fact GROUP BY {col}")


@register("health_share", _share_sql("health_implication"))
def q_health_share(spark, sf_dir):
    return share_by(fact(spark, sf_dir), "health_implication")


@register("dominant_share", _share_sql("dominant_pollutant"))
def q_dominant_share(spark, sf_dir):
    return share_by(fact(spark, sf_dir), "dominant_pollutant")


@register("pattern_month", O.with_fact(
    f"SELECT location_id, cast(month(measure_date) AS int) AS month, "
    f"{O.mean_sql('avg_pm2_5')} AS avg_avg_pm2_5, max(avg_pm2_5) AS max_avg_pm2_5, "
    "count(avg_pm2_5) AS n FROM fact GROUP BY 1, 2"))
def q_pattern_month(spark, sf_dir):
    return pattern_by(fact(spark, sf_dir), "month", "avg_pm2_5", ts="measure_date",
                      by=("location_id",))
