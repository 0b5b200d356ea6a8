"""Series, forecast and sliding-window queries.

Long series come from ``orders``: one series per order priority, ``y`` the exact
daily total of ``o_totalprice`` (about 2,400 days at every scale factor).
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from airindex.operators.forecast import forecast_fourier, forecast_linear
from airindex.operators.series import (METRICS, clip_columns, daily_total_series, future_frame,
                                       last_n, last_observation, mask_outliers, to_series,
                                       with_anchor)
from airindex.plans import oracle as O
from airindex.plans.catalog import register
from airindex.plans.daily import daily_air_index
from airindex.sources.tables import load, readings
from airindex.streaming.landing import sliding_mean

HORIZON = 30
RECENT_DAYS = 90
Q = 0.99


def order_series(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    return daily_total_series(orders, "o_orderpriority", "o_orderdate", "o_totalprice", scale=2)


def masked_series(spark, sf_dir):
    return mask_outliers(order_series(spark, sf_dir), Q)


SERIES_CTE = f"""WITH s AS (
  SELECT o_orderpriority AS series_id, cast(o_orderdate AS date) AS ds,
         cast(sum({O.units_sql('o_totalprice', 2)}) AS double) / 100.0::double AS y
  FROM orders GROUP BY 1, 2),
q AS (SELECT series_id, quantile_cont(y, {Q}) AS q99 FROM s WHERE y IS NOT NULL GROUP BY 1),
masked AS (SELECT s.series_id, s.ds, CASE WHEN s.y <= q.q99 THEN s.y END AS y
           FROM s JOIN q USING (series_id) WHERE s.y IS NOT NULL)"""


@register("series_long", O.with_fact(", wide AS (SELECT location_id, measure_date AS ds, "
                                     + ", ".join(f"cast({m} AS double) AS {m}" for m in METRICS)
                                     + " FROM fact)\nSELECT cast(location_id AS varchar) || '/' "
                                     "|| metric AS series_id, location_id, metric, ds, y FROM "
                                     f"wide UNPIVOT (y FOR metric IN ({', '.join(METRICS)}))"))
def q_series_long(spark, sf_dir):
    return to_series(daily_air_index(readings(spark, sf_dir)))


@register("mask_outliers_p99", SERIES_CTE + "\nSELECT series_id, ds, y FROM masked")
def q_mask_outliers_p99(spark, sf_dir):
    return masked_series(spark, sf_dir)


@register("last_observation", SERIES_CTE + """
SELECT series_id, ds, y FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds DESC) AS rn FROM masked)
WHERE rn = 1""")
def q_last_observation(spark, sf_dir):
    return last_observation(masked_series(spark, sf_dir))


@register("last_n_per_series", SERIES_CTE + f"""
SELECT series_id, ds, y FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds DESC) AS rn FROM masked)
WHERE rn <= {RECENT_DAYS}""")
def q_last_n_per_series(spark, sf_dir):
    return last_n(masked_series(spark, sf_dir), RECENT_DAYS)


@register("future_frame", SERIES_CTE + f"""
SELECT series_id, cast(last + cast(g.step AS int) AS date) AS ds, cast(g.step AS int) AS step
FROM (SELECT series_id, max(ds) AS last FROM masked GROUP BY 1), generate_series(1, {HORIZON}) AS g(step)""")
def q_future_frame(spark, sf_dir):
    return future_frame(masked_series(spark, sf_dir), HORIZON)


FORECAST_SQL = SERIES_CTE + f""",
m AS (SELECT series_id, ds, y, cast(date_diff('day', DATE '1970-01-01', ds) AS double) AS t,
             cast(isodow(ds) - 1 AS int) AS wd FROM masked WHERE y IS NOT NULL),
fit AS (SELECT *, regr_slope(y, t) OVER (PARTITION BY series_id) AS b,
               regr_intercept(y, t) OVER (PARTITION BY series_id) AS a FROM m),
r AS (SELECT *, y - (a + b * t) AS r FROM fit),
e AS (SELECT *, avg(r) OVER (PARTITION BY series_id, wd) AS e FROM r),
r2 AS (SELECT *, r - e AS r2 FROM e),
params AS (SELECT series_id, any_value(a) AS a, any_value(b) AS b,
                  quantile_cont(r2, 0.1) AS lo, quantile_cont(r2, 0.9) AS hi FROM r2 GROUP BY 1),
effects AS (SELECT DISTINCT series_id, wd, e FROM r2),
fut AS (SELECT series_id, cast(last + cast(g.step AS int) AS date) AS ds, cast(g.step AS int) AS step
        FROM (SELECT series_id, max(ds) AS last FROM masked GROUP BY 1),
             generate_series(1, {HORIZON}) AS g(step)),
pred AS (SELECT f.series_id, f.ds, f.step,
                p.a + p.b * cast(date_diff('day', DATE '1970-01-01', f.ds) AS double)
                  + coalesce(ef.e, 0.0) AS yhat, p.lo, p.hi
         FROM fut f JOIN params p USING (series_id)
         LEFT JOIN effects ef ON ef.series_id = f.series_id
                              AND ef.wd = cast(isodow(f.ds) - 1 AS int)),
forecast AS (SELECT series_id, ds, step, {O.rnd('yhat')} AS yhat,
                    {O.rnd('yhat + lo')} AS yhat_lower, {O.rnd('yhat + hi')} AS yhat_upper
             FROM pred)"""


@register("forecast_trend_weekday", FORECAST_SQL + "\nSELECT * FROM forecast")
def q_forecast_trend_weekday(spark, sf_dir):
    return forecast_linear(masked_series(spark, sf_dir), HORIZON)


def _clip(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN NULL ELSE greatest({c}, 0.0) END AS {c}"


@register("forecast_with_anchor", FORECAST_SQL + f""",
anchor AS (SELECT series_id, ds, 0 AS step, y AS yhat, y AS yhat_lower, y AS yhat_upper FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds DESC) AS rn FROM masked)
  WHERE rn = 1),
allrows AS (SELECT * FROM anchor UNION ALL SELECT * FROM forecast)
SELECT series_id, ds, step, {_clip('yhat')}, {_clip('yhat_lower')}, {_clip('yhat_upper')}
FROM allrows""")
def q_forecast_with_anchor(spark, sf_dir):
    masked = masked_series(spark, sf_dir)
    return clip_columns(with_anchor(forecast_linear(masked, HORIZON), masked))


FOURIER_GRID_SQL = SERIES_CTE + f""",
last AS (SELECT series_id, max(ds) AS last FROM masked GROUP BY 1)
SELECT series_id, cast(last + cast(g.step AS int) AS date) AS ds, cast(g.step AS int) AS step,
       true AS ordered, true AS whole, true AS constant_band, true AS in_range
FROM last, generate_series(1, {HORIZON}) AS g(step)"""


def _checked(forecast, masked):
    """A row per forecast row with what must hold of it: bounds in order and none missing, one
    band per series, and no prediction far off the series' own range."""
    span = masked.groupBy("series_id").agg(F.min("y").alias("low"), F.max("y").alias("high"))
    w = Window.partitionBy("series_id")
    up = F.col("yhat_upper") - F.col("yhat")
    wide = F.col("high") - F.col("low")
    return (forecast.join(span, "series_id").withColumn("_up", up)
            .withColumns({"_least": F.min("_up").over(w), "_most": F.max("_up").over(w)})
            .select("series_id", "ds", "step",
                    ((F.col("yhat_lower") <= F.col("yhat")) & (F.col("yhat") <= F.col("yhat_upper"))).alias("ordered"),
                    (F.col("yhat").isNotNull() & F.col("yhat_lower").isNotNull() & F.col("yhat_upper").isNotNull()).alias("whole"),
                    (F.col("_most") - F.col("_least") <= wide * 1e-9).alias("constant_band"),
                    F.col("yhat").between(F.col("low") - wide, F.col("high") + wide).alias("in_range")))


@register("forecast_fourier")
def q_forecast_fourier(spark, sf_dir):
    """Trend + Fourier seasonality per series (numpy inside applyInPandas; rows-only check)."""
    return clip_columns(forecast_fourier(masked_series(spark, sf_dir), HORIZON))


@register("forecast_fourier_checks", FOURIER_GRID_SQL)
def q_forecast_fourier_checks(spark, sf_dir):
    """The Fourier forecast's series / day / step grid and what must hold of each row (the
    values are compared with a direct refit in the tests)."""
    masked = masked_series(spark, sf_dir)
    return _checked(forecast_fourier(masked, HORIZON), masked)


@register("forecast_holidays", FOURIER_GRID_SQL)
def q_forecast_holidays(spark, sf_dir):
    """The same with a holiday calendar: the first day of every month the orders span."""
    masked = masked_series(spark, sf_dir)
    months = masked.agg(F.min("ds").alias("a"), F.date_add(F.max("ds"), HORIZON).alias("b")).select(
        F.explode(F.sequence(F.trunc("a", "month"), "b", F.expr("interval 1 month"))).alias("holiday"))
    return _checked(forecast_fourier(masked, HORIZON, holidays=months), masked)


@register("sliding_8h_batch", O.with_readings(f"""
SELECT location_id, measured_at - to_hours(k) AS window_start,
       measured_at - to_hours(k) + INTERVAL 8 HOUR AS window_end,
       {O.mean_sql('o3', 6)} AS mean_o3, count(o3) AS n_o3, count(*) AS n_readings
FROM readings, range(8) AS r(k) GROUP BY 1, 2, 3"""))
def q_sliding_8h_batch(spark, sf_dir):
    """8-hour windows sliding by 1 hour (event time), per location."""
    return sliding_mean(readings(spark, sf_dir))
