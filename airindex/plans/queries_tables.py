"""Tables that stay put, stored quantile sketches, rank and lagged correlations, dense row windows."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Window
from pyspark.sql import functions as F

from airindex.operators.numbering import rolling_rows_dense
from airindex.operators.patterns import CORR_DIGITS, lagged_correlation, rank_correlation
from airindex.operators.sketches import day_sketches, merged, quantile, store_sketches
from airindex.operators.upsert import upsert_partitioned
from airindex.plans import oracle as O
from airindex.plans.catalog import register
from airindex.plans.queries_io import (READING_COLUMNS, READING_SPLIT_SQL, SPLIT_FIRST_UPDATE_DAY, SPLIT_LAST_TARGET_DAY,
                                       merge_sql, reading_target, reading_updates)
from airindex.schemas import POLLUTANTS, READING, READING_KEYS, READING_UPDATE_COLS
from airindex.session import scratch_path
from airindex.sinks.bucketed import merge_bucketed, save_bucketed
from airindex.sources.tables import load, readings

MERGED_SQL = READING_SPLIT_SQL + "\n" + merge_sql(READING_COLUMNS, READING_KEYS, READING_UPDATE_COLS)
assert (SPLIT_LAST_TARGET_DAY, SPLIT_FIRST_UPDATE_DAY) == (20, 18)


def bucketed_readings(spark, sf_dir):
    """The readings of days 1-20 as a bucketed table, with days 18 and later merged in: the table's name."""
    r = readings(spark, sf_dir).select(*READING_COLUMNS)
    name = f"readings_{uuid4().hex}"
    save_bucketed(reading_target(r), name, 8)
    merge_bucketed(spark, name, reading_updates(r), READING_KEYS, READING_UPDATE_COLS, 8)
    return name


@register("bucketed_merge", O.with_readings(MERGED_SQL))
def q_bucketed_merge(spark, sf_dir):
    """A keyed merge into a bucketed table, by name."""
    return spark.table(bucketed_readings(spark, sf_dir)).select(*READING_COLUMNS)


@register("bucketed_rolling", O.with_readings(READING_SPLIT_SQL + ",\nmerged AS ("
                                              + merge_sql(READING_COLUMNS, READING_KEYS, READING_UPDATE_COLS) + f""")
SELECT location_id, measured_at, pm2_5, {O.window_mean_sql('pm2_5')} AS rolling_pm2_5, count(pm2_5) OVER w AS count_pm2_5 FROM merged
WINDOW w AS (PARTITION BY location_id ORDER BY measured_at ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)"""))
def q_bucketed_rolling(spark, sf_dir):
    """8-row means over the merged table, read bucket by bucket without an exchange."""
    from airindex.functions.exact import exact_window_mean
    w = Window.partitionBy("location_id").orderBy("measured_at").rowsBetween(-7, 0)
    return spark.table(bucketed_readings(spark, sf_dir)).select(
        "location_id", "measured_at", "pm2_5", exact_window_mean("pm2_5", w).alias("rolling_pm2_5"), F.count("pm2_5").over(w).alias("count_pm2_5"))


@register("upsert_key_parts", O.with_readings(MERGED_SQL))
def q_upsert_key_parts(spark, sf_dir):
    """The upsert of late readings into a table whose days are dealt out by location: only touched parts are rewritten."""
    r = readings(spark, sf_dir).select(*READING_COLUMNS)
    path = scratch_path(spark, "parts")
    upsert_partitioned(spark, path, reading_target(r), READING_KEYS, "measure_date", READING_UPDATE_COLS, schema=READING, parts=4)
    upsert_partitioned(spark, path, reading_updates(r), READING_KEYS, "measure_date", READING_UPDATE_COLS, schema=READING, parts=4)
    return spark.read.parquet(path).select(*READING_COLUMNS)


QUANTILES = (0.5, 0.9, 0.99)
RANK_ERROR = 0.03


@register("sketch_quantiles", O.with_readings(f"""
, ranges AS (SELECT * FROM (VALUES ('first half', 1, 15), ('second half', 16, 31), ('all', 1, 31)) AS t(period, a, b))
SELECT period, location_id, q, count(*) AS n, true AS close
FROM readings JOIN ranges ON day(measure_date) BETWEEN a AND b, (VALUES {', '.join(f'({q}::DOUBLE)' for q in QUANTILES)}) AS v(q)
WHERE pm2_5 IS NOT NULL GROUP BY 1, 2, 3"""))
def q_sketch_quantiles(spark, sf_dir):
    """Quantiles of three ranges of days from stored day sketches, and whether their rank is that of the exact
    one: the share of the range's values below and up to the answer must enclose q, give or take {RANK_ERROR}."""
    r = readings(spark, sf_dir)
    path = scratch_path(spark, "sketches")
    store_sketches(day_sketches(r, "pm2_5"), path)
    day = F.dayofmonth("measure_date")
    period = F.explode(F.array(F.when(day <= 15, "first half").otherwise("second half"), F.lit("all"))).alias("period")
    stored = spark.read.parquet(path)
    of_range = merged(stored.select("*", period), ("period", "location_id"))
    asked = of_range.select("period", "location_id", "n", F.explode(F.array(*[
        F.struct(F.lit(q).alias("q"), quantile("sketch", q).alias("value")) for q in QUANTILES])).alias("a")).select("period", "location_id", "n", "a.*")
    values = r.filter("pm2_5 IS NOT NULL").select("location_id", "pm2_5", period)
    exact = values.join(asked, ["period", "location_id"]).groupBy("period", "location_id", "q").agg(
        F.max("n").alias("n"), (F.count_if(F.col("pm2_5") < F.col("value")) / F.count("*")).alias("below"),
        (F.count_if(F.col("pm2_5") <= F.col("value")) / F.count("*")).alias("up_to"))
    return exact.select("period", "location_id", "q", "n", F.col("q").between(F.col("below") - RANK_ERROR, F.col("up_to") + RANK_ERROR).alias("close"))


_RANKED = ", ".join(
    f"CASE WHEN {c} IS NOT NULL THEN (rank() OVER (PARTITION BY {c} IS NULL ORDER BY {c})) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE END AS {c}"
    for c in POLLUTANTS)


@register("pollutant_rank_correlation", O.with_readings(f", ranked AS (SELECT {_RANKED} FROM readings)\n" + "\n UNION ALL ".join(
    f"SELECT {O.q(a)} AS pollutant_a, {O.q(b)} AS pollutant_b, {O.rnd(f'corr({a}, {b})', CORR_DIGITS)} AS corr, "
    f"cast(count_if({a} IS NOT NULL AND {b} IS NOT NULL) AS bigint) AS n FROM ranked"
    for i, a in enumerate(POLLUTANTS) for b in POLLUTANTS[i + 1:])))
def q_pollutant_rank_correlation(spark, sf_dir):
    """Spearman's correlation of every pollutant pair, ties at their mean rank."""
    return rank_correlation(readings(spark, sf_dir))


LAGS = 24


@register("pollutant_lagged_correlation", O.with_readings(f"""
SELECT k::INT AS lag_hours, {O.rnd('corr(b.no2, a.pm2_5)', CORR_DIGITS)} AS corr,
       cast(count_if(a.pm2_5 IS NOT NULL AND b.no2 IS NOT NULL) AS bigint) AS n
FROM range({LAGS + 1}) AS t(k), readings a LEFT JOIN readings b ON b.location_id = a.location_id AND b.measured_at = a.measured_at - to_hours(k::INT)
GROUP BY k"""))
def q_pollutant_lagged_correlation(spark, sf_dir):
    """Correlation of PM2.5 with NO2 as it was up to a day before, aligned by hour."""
    return lagged_correlation(readings(spark, sf_dir), "no2", "pm2_5", LAGS)


@register("rolling_dense", f"""
SELECT l_returnflag, l_orderkey, l_linenumber, l_extendedprice, {O.window_mean_sql('l_extendedprice')} AS rolling_l_extendedprice,
       count(l_extendedprice) OVER w AS count_l_extendedprice
FROM lineitem WINDOW w AS (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_extendedprice ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)""")
def q_rolling_dense(spark, sf_dir):
    """8-row means over very few, very long groups: every line item, per return flag, in numbered segments."""
    items = load(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice")
    return rolling_rows_dense(items, "l_extendedprice", ["l_returnflag"], ["l_orderkey", "l_linenumber", "l_extendedprice"], segment=4096)
