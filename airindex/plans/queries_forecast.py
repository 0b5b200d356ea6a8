"""Forecasts with sparse changepoints, priors and holidays, over the long ``orders`` series.

The feature sums that the fit is made from have an SQL twin value by value. That the fitted
coefficients are the optimum is shown from the rows themselves: no coefficient can gain.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from airindex.functions.holidays import NAMES, SOLAR
from airindex.operators.changepoints import (Model, components, fit_changepoints, forecast_changepoints, optimality,
                                             solar_calendar, spans, stretch_statistics, vietnamese_calendar, with_features)
from airindex.operators.series import clip_columns, future_frame, with_anchor
from airindex.plans.catalog import register
from airindex.plans.queries_series import HORIZON, SERIES_CTE, masked_series

FULL = Model(holidays=NAMES)
FIXED_DATES = Model(holidays=tuple(SOLAR))
DIGITS = 4

# Fixed values, stated again for the twin: solar holidays, changepoints, seasons.
_HOLIDAYS_SQL = ("[(1, 1), (4, 30), (5, 1), (9, 2)]")
FEATURES_SQL = SERIES_CTE + f""",
seen AS (SELECT * FROM masked WHERE y IS NOT NULL),
span AS (SELECT series_id, min(ds) AS first, greatest(date_diff('day', min(ds), max(ds)), 1) AS days,
                CASE WHEN max(abs(y)) > 0 THEN max(abs(y)) ELSE 1.0 END AS scale FROM seen GROUP BY 1),
scaled AS (SELECT series_id, ds, y / scale AS y, date_diff('day', first, ds) / days::DOUBLE AS u, days,
              date_diff('day', DATE '1970-01-01', ds)::DOUBLE AS d FROM seen JOIN span USING (series_id)),
design AS (SELECT series_id, ds, y, list_concat(
    [1.0::DOUBLE, u], list_transform(range(1, 26), lambda j: greatest(u - 0.8 * j / 26, 0.0)),
    flatten(list_transform(range(1, 4), lambda k: CASE WHEN days >= 14 THEN [sin(d * (2 * pi() * k / 7)), cos(d * (2 * pi() * k / 7))] ELSE [0.0, 0.0] END)),
    flatten(list_transform(range(1, 11), lambda k: CASE WHEN days >= 730 THEN [sin(d * (2 * pi() * k / 365.25)), cos(d * (2 * pi() * k / 365.25))] ELSE [0.0, 0.0] END)),
    list_transform({_HOLIDAYS_SQL}, lambda h: CASE WHEN h = (month(ds)::INT, day(ds)::INT) THEN 1.0 ELSE 0.0 END)) AS x FROM scaled)"""
SIZE = FIXED_DATES.size


@register("forecast_statistics", FEATURES_SQL + f"""
SELECT series_id, i::INT AS i, j::INT AS j, round(sum(x[i + 1] * x[j + 1]), {DIGITS}) + 0.0 AS xx,
       round(sum(x[i + 1] * y), {DIGITS}) + 0.0 AS xy, count(*) AS n
FROM design, range({SIZE}) AS a(i), range({SIZE}) AS b(j) WHERE i <= j GROUP BY 1, 2, 3""")
def q_forecast_statistics(spark, sf_dir):
    """What the solver gets: sums of feature products (i <= j) and of features times values, per series."""
    series = masked_series(spark, sf_dir)
    rows = with_features(series, spans(series), FIXED_DATES, solar_calendar(series, HORIZON))
    at = stretch_statistics(rows, FIXED_DATES).select("series_id", "n", "xy", F.posexplode("xx").alias("at", "value"))
    at = at.withColumns({"i": F.expr(f"at div {SIZE}").cast("int"), "j": (F.col("at") % SIZE).cast("int")}).filter("i <= j")
    return at.groupBy("series_id", "i", "j").agg(
        (F.round(F.sum("value"), DIGITS) + 0.0).alias("xx"), (F.round(F.sum(F.get("xy", F.col("i"))), DIGITS) + 0.0).alias("xy"),
        F.sum("n").alias("n"))


@register("forecast_changepoints")
def q_forecast_changepoints(spark, sf_dir):
    """The dashboard's forecast: sparse changepoints, priors, Vietnamese holidays, widening band, anchor row,
    clipped at zero (rows-only here; the fit is checked by the queries below)."""
    series = masked_series(spark, sf_dir)
    out = forecast_changepoints(series, HORIZON, FULL, vietnamese_calendar(series, HORIZON))
    return clip_columns(with_anchor(out, series))


@register("forecast_changepoints_optimality", SERIES_CTE + f"""
SELECT DISTINCT series_id, f::INT AS feature, true AS optimal FROM masked, range({FULL.size}) AS t(f) WHERE y IS NOT NULL""")
def q_forecast_changepoints_optimality(spark, sf_dir):
    """No coefficient of any series' fit can gain: slopes summed from the series' rows, against the priors."""
    series = masked_series(spark, sf_dir)
    calendar = vietnamese_calendar(series, HORIZON)
    return optimality(series, fit_changepoints(series, HORIZON, FULL, calendar), FULL, calendar)


@register("forecast_holiday_effects", SERIES_CTE + f""",
days AS (SELECT series_id, ds, 0 AS step FROM masked UNION ALL
  SELECT series_id, cast(last + cast(g.step AS int) AS date), cast(g.step AS int)
  FROM (SELECT series_id, max(ds) AS last FROM masked GROUP BY 1), generate_series(1, {HORIZON}) AS g(step))
SELECT series_id, ds, step, list_contains({_HOLIDAYS_SQL}, (month(ds)::INT, day(ds)::INT)) AS has_effect, true AS adds_up FROM days""")
def q_forecast_holiday_effects(spark, sf_dir):
    """Days of history and horizon on which a holiday moves the forecast: its own days and no others."""
    series = masked_series(spark, sf_dir)
    calendar = solar_calendar(series, HORIZON)
    days = series.select("series_id", "ds", F.lit(0).alias("step")).unionByName(future_frame(series, HORIZON))
    out = components(days, fit_changepoints(series, HORIZON, FIXED_DATES, calendar), FIXED_DATES, calendar)
    rest = F.col("trend") + F.col("weekly") + F.col("yearly")
    return out.select("series_id", "ds", "step", (F.col("holidays") != 0).alias("has_effect"),
                      ((F.col("yhat") != rest) == (F.col("holidays") != 0)).alias("adds_up"))


@register("forecast_band", SERIES_CTE + f"""
SELECT series_id, cast(last + cast(g.step AS int) AS date) AS ds, cast(g.step AS int) AS step, true AS inside, true AS widens
FROM (SELECT series_id, max(ds) AS last FROM masked GROUP BY 1), generate_series(1, {HORIZON}) AS g(step)""")
def q_forecast_band(spark, sf_dir):
    """The band holds the forecast and never narrows with the step (how far it widens: see the tests)."""
    series = masked_series(spark, sf_dir)
    out = forecast_changepoints(series, HORIZON, FIXED_DATES, solar_calendar(series, HORIZON))
    w = Window.partitionBy("series_id").orderBy("step")
    width = F.col("yhat_upper") - F.col("yhat_lower")
    tiny = F.abs("yhat") * 1e-12  # the width is a difference of large values
    return out.select("series_id", "ds", "step", F.col("yhat").between(F.col("yhat_lower"), F.col("yhat_upper")).alias("inside"),
                      (width >= F.coalesce(F.lag(width).over(w), width) - tiny).alias("widens"))
