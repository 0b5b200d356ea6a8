"""Index, label and scalar-function queries (projections of readings and the fact)."""

from __future__ import annotations

from pyspark.sql import functions as F

from airindex.functions.dates import (clip_at_zero, date_id, epoch_to_timestamp, slug,
                                      to_epoch)
from airindex.functions.index import SUB_INDEXES, breakpoint_table
from airindex.plans import oracle as O
from airindex.plans.catalog import register
from airindex.operators.rolling import BUCKET, rolling_rows
from airindex.operators.rollup import daily_rollup
from airindex.plans.daily import daily_air_index, with_sub_indexes
from airindex.sources.tables import load, readings


def fact_ext(spark, sf_dir):
    """Daily fact with the sub-index columns kept."""
    return daily_air_index(readings(spark, sf_dir), keep_sub_indexes=True)


def _fact_query(name: str, cols: tuple[str, ...]):
    sql = O.with_fact(f"SELECT {', '.join(cols)} FROM fact_all")

    @register(name, sql)
    def run(spark, sf_dir):
        return fact_ext(spark, sf_dir).select(*cols)
    run.__name__ = f"q_{name}"
    return run


for _name, (_src, _segs) in O.SUB_INDEXES.items():
    _fact_query("index_" + _name[len("aqi_"):], ("location_id", "measure_date", _src, _name))

_fact_query("ozone_index", ("location_id", "measure_date", "max_1h_o3", "max_8h_o3",
                            "aqi_o3_1h", "aqi_o3_8h", "aqi_o3"))
_fact_query("overall_index", ("location_id", "measure_date", "aqi_pm25", "aqi_pm10", "aqi_co",
                              "aqi_no2", "aqi_so2", "aqi_o3", "vn_aqi_raw"))
_fact_query("quality_status", ("location_id", "measure_date", "record_count", "avg_pm2_5",
                               "avg_pm10", "data_quality_status", "vn_aqi"))
_fact_query("health_label", ("location_id", "measure_date", "vn_aqi", "health_implication",
                             "is_hazardous"))
_fact_query("dominant_pollutant", ("location_id", "measure_date", "vn_aqi", "vn_aqi_raw",
                                   "dominant_pollutant"))


_BP_LONG = " UNION ALL ".join(
    f"SELECT location_id, measure_date, {O.q(name)} AS sub_index, {src} AS x, "
    f"{O.piecewise_sql(src, segs)} AS idx FROM fact_all"
    for name, (src, segs) in O.SUB_INDEXES.items())


@register("index_by_breakpoint_join", O.with_fact(_BP_LONG))
def q_index_by_breakpoint_join(spark, sf_dir):
    """Sub-indexes from a breakpoint *table*: broadcast range join, one segment per value.

    The breakpoint table has a fixed, small size (one row per segment), so it is
    broadcast; the join is an equi-join on the sub-index name plus a range test.
    """
    fact = fact_ext(spark, sf_dir)
    long = fact.select("location_id", "measure_date", F.explode(F.array(*[
        F.struct(F.lit(name).alias("sub_index"), F.col(src).cast("double").alias("x"))
        for name, (src, _) in SUB_INDEXES.items()])).alias("v")).select(
        "location_id", "measure_date", "v.*")
    bp = F.broadcast(breakpoint_table(spark))
    above = (long.x > bp.lo) | ((bp.seg == 0) & (long.x >= bp.lo))
    cond = (long.sub_index == bp.sub_index) & above & (long.x <= bp.hi)
    value = bp.slope * (long.x - bp.lo) + bp.i_lo
    return long.join(bp, cond, "left").select(
        long.location_id, long.measure_date, long.sub_index, long.x,
        F.coalesce(value, F.lit(0.0)).cast("int").alias("idx"))


@register("level_label", O.with_readings(
    "SELECT location_id, measured_at, aqi_level, aqi_label FROM readings"))
def q_level_label(spark, sf_dir):
    return readings(spark, sf_dir).select("location_id", "measured_at", "aqi_level", "aqi_label")


@register("date_parts", O.with_readings(
    "SELECT location_id, measured_at, measure_date, measure_year, measure_month, measure_day "
    "FROM readings"))
def q_date_parts(spark, sf_dir):
    return readings(spark, sf_dir).select("location_id", "measured_at", "measure_date",
                                          "measure_year", "measure_month", "measure_day")


@register("epoch_to_timestamp", O.with_readings(
    "SELECT location_id, measured_at, cast(epoch(measured_at) AS bigint) AS epoch_seconds, "
    "make_timestamp(cast(epoch(measured_at) AS bigint) * 1000000) AS measured_at_back "
    "FROM readings"))
def q_epoch_to_timestamp(spark, sf_dir):
    r = readings(spark, sf_dir).select("location_id", "measured_at")
    r = r.withColumn("epoch_seconds", to_epoch("measured_at"))
    return r.withColumn("measured_at_back", epoch_to_timestamp("epoch_seconds"))


@register("date_id", O.with_readings(
    f"SELECT DISTINCT measure_date, {O.date_id_sql('measure_date')} AS date_id FROM readings"))
def q_date_id(spark, sf_dir):
    return (readings(spark, sf_dir).select("measure_date").distinct()
            .withColumn("date_id", date_id("measure_date")))


@register("city_slug", "SELECT cast(n_nationkey AS int) AS location_id, n_name AS city_name, "
                       "replace(lower(n_name), ' ', '_') AS city_slug FROM nation")
def q_city_slug(spark, sf_dir):
    n = load(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").cast("int").alias("location_id"),
                    F.col("n_name").alias("city_name"), slug("n_name").alias("city_slug"))


@register("clip_at_zero", O.with_readings(
    "SELECT location_id, measured_at, o3, CASE WHEN o3 IS NULL THEN NULL "
    "ELSE greatest(o3 - 100, 0.0) END AS o3_excess FROM readings"))
def q_clip_at_zero(spark, sf_dir):
    r = readings(spark, sf_dir).select("location_id", "measured_at", "o3")
    return r.withColumn("o3_excess", clip_at_zero(F.col("o3") - F.lit(100)))


_CLAMP_COLS = ["location_id", "measure_date"] + [src for src, _ in SUB_INDEXES.values()]


@register("index_clamped", O.with_fact(", clamped AS (SELECT " + ", ".join(
    _CLAMP_COLS + [f"{O.piecewise_sql(src, segs, 'clamp')} AS {name}"
                   for name, (src, segs) in O.SUB_INDEXES.items()]) + " FROM fact_all)\n"
    "SELECT * FROM clamped"))
def q_index_clamped(spark, sf_dir):
    """Sub-indexes with off-scale concentrations clamped to the top index (not 0)."""
    rolled = rolling_rows(readings(spark, sf_dir), "o3", keep_bucket=True)
    daily = daily_rollup(rolled, keys=("location_id", BUCKET, "measure_date")).drop(BUCKET)
    return with_sub_indexes(daily, off_scale="clamp").select(
        *_CLAMP_COLS, *SUB_INDEXES.keys())
