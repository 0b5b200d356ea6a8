"""Core queries: readings, rolling ozone, daily rollup and the daily index fact."""

from __future__ import annotations

from pyspark.sql import functions as F

from airindex.operators.rolling import rolling_rows, rolling_seconds
from airindex.operators.rollup import daily_rollup
from airindex.plans import oracle as O
from airindex.plans.catalog import register
from airindex.plans.daily import daily_air_index, daily_pm_index
from airindex.sources.tables import readings


@register("scan_readings", O.with_readings(f"SELECT {O.READING_COLS} FROM readings"))
def scan_readings(spark, sf_dir):
    return readings(spark, sf_dir)


@register("daily_air_index", O.with_fact("SELECT * FROM fact"))
def q_daily_air_index(spark, sf_dir):
    return daily_air_index(readings(spark, sf_dir))


_PM_SQL = O.with_readings(f"""
, daily AS ({O.rollup_sql('readings', with_8h=False)}),
idx AS (SELECT *, {O.piecewise_sql('avg_pm2_5', O.SUB_INDEXES['aqi_pm25'][1])} AS aqi_pm25,
               {O.piecewise_sql('avg_pm10', O.SUB_INDEXES['aqi_pm10'][1])} AS aqi_pm10 FROM daily),
g AS (SELECT *, CASE WHEN {O.valid_sql()} THEN cast(greatest(aqi_pm25, aqi_pm10) AS int) END
                AS pm_index, {O.status_sql()} AS data_quality_status FROM idx)
SELECT location_id, measure_date, avg_pm2_5, avg_pm10, aqi_pm25, aqi_pm10, pm_index,
       data_quality_status, {O.health_label_sql('pm_index')} AS health_implication, record_count
FROM g""")


@register("daily_pm_index", _PM_SQL)
def q_daily_pm_index(spark, sf_dir):
    return daily_pm_index(readings(spark, sf_dir))


@register("rolling_8_rows", O.with_rolled(
    f"SELECT location_id, measured_at, o3, {O.rnd('rolling_o3', 6)} AS rolling_o3, "
    "count_o3 FROM rolled"))
def q_rolling_8_rows(spark, sf_dir):
    r = rolling_rows(readings(spark, sf_dir).select("location_id", "measured_at", "measure_date",
                                                    "o3"), "o3", rows=8)
    return r.select("location_id", "measured_at", "o3", F.round("rolling_o3", 6).alias("rolling_o3"),
                    "count_o3")


@register("rolling_8_hours", O.with_readings(
    f"""SELECT location_id, measured_at, o3, {O.rnd(O.window_mean_sql('o3'), 6)} AS rolling_o3,
       count(o3) OVER w AS count_o3 FROM readings
WINDOW w AS (PARTITION BY location_id ORDER BY epoch(measured_at)
             RANGE BETWEEN 25200 PRECEDING AND CURRENT ROW)"""))
def q_rolling_8_hours(spark, sf_dir):
    r = rolling_seconds(readings(spark, sf_dir).select("location_id", "measured_at",
                                                       "measure_date", "o3"), "o3", 8 * 3600)
    return r.select("location_id", "measured_at", "o3", F.round("rolling_o3", 6).alias("rolling_o3"),
                    "count_o3")


@register("daily_rollup", O.with_readings(O.rollup_sql("readings", with_8h=False)))
def q_daily_rollup(spark, sf_dir):
    return daily_rollup(readings(spark, sf_dir))


@register("daily_max_rolling", O.with_rolled(
    f"SELECT location_id, measure_date, "
    f"{O.rnd(f'max(CASE WHEN count_o3 >= {O.MIN_8H_VALUES} THEN rolling_o3 END)')} AS max_8h_o3, "
    "cast(count(*) AS int) AS record_count FROM rolled GROUP BY 1, 2"))
def q_daily_max_rolling(spark, sf_dir):
    from airindex.operators.rollup import MIN_8H_VALUES
    from airindex.operators.rolling import BUCKET
    r = rolling_rows(readings(spark, sf_dir), "o3", rows=8, keep_bucket=True)
    # Group on the window's keys plus the day: no extra shuffle.
    return r.groupBy("location_id", BUCKET, "measure_date").agg(
        F.round(F.max(F.when(F.col("count_o3") >= MIN_8H_VALUES, F.col("rolling_o3"))), 2)
        .alias("max_8h_o3"),
        F.count(F.lit(1)).cast("int").alias("record_count")).drop(BUCKET)
