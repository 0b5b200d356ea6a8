"""Per-series operators: long form, outlier masking, last rows, future frames, anchors.

A series is ``(series_id, ds, y)`` with one row per day, so every per-series
group is bounded by the number of days, not by data volume; many series run in
one job, spread over tasks by ``series_id``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airindex.functions.dates import clip_at_zero, mask_above
from airindex.functions.exact import sum_exact

# Forecast targets (daily fact columns).
METRICS = ("vn_aqi", "avg_pm2_5", "avg_pm10", "avg_co", "avg_no2", "avg_so2", "avg_o3")


def to_series(fact: DataFrame, metrics: Sequence[str] = METRICS,
              key: str = "location_id", day: str = "measure_date") -> DataFrame:
    """Daily fact -> long series (series_id, location_id, metric, ds, y), NULL y dropped."""
    cols = [F.col(m).cast("double").alias(m) for m in metrics]
    wide = fact.select(key, F.col(day).alias("ds"), *cols)
    long = wide.unpivot([key, "ds"], list(metrics), "metric", "y").filter(F.col("y").isNotNull())
    sid = F.concat_ws("/", F.col(key).cast("string"), F.col("metric"))
    return long.select(sid.alias("series_id"), key, "metric", "ds", "y")


def daily_total_series(df: DataFrame, group: str, ts: str, value: str,
                       scale: int = 2) -> DataFrame:
    """(series_id = group, ds = day of ts, y = exact daily total of value)."""
    return (df.groupBy(F.col(group).alias("series_id"), F.to_date(F.col(ts)).alias("ds"))
            .agg(sum_exact(value, scale).alias("y")))


def mask_outliers(series: DataFrame, q: float = 0.99, exact: bool = True,
                  accuracy: int = 10000) -> DataFrame:
    """Values above the per-series ``q`` quantile become NULL (NULL inputs dropped first).

    The quantile is a window aggregate over ``series_id``: one shuffle of the
    (daily, hence day-bounded) series rows, and the source is scanned once. A
    grouped aggregate joined back would scan the source twice, which costs more
    than it saves when the series come from a large table. ``exact`` interpolates
    linearly between order statistics; otherwise ``percentile_approx`` with the
    given accuracy (fixed-size state).
    """
    w = Window.partitionBy("series_id")
    s = series.filter(F.col("y").isNotNull())
    qv = F.percentile("y", q) if exact else F.percentile_approx("y", q, accuracy)
    return (s.withColumn("_q", qv.over(w))
            .withColumn("y", mask_above("y", "_q")).drop("_q"))


def top_n(df: DataFrame, group: Sequence[str], order: Sequence, n: int,
          rank_col: str | None = None) -> DataFrame:
    """First ``n`` rows of each group by ``order`` (Columns or names; make it total for a
    deterministic result). ``row_number() <= n`` is planned as a partial
    ``WindowGroupLimit`` before the shuffle, so each task keeps at most ``n`` rows per
    group, however large (or skewed) the group.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    out = df.withColumn(rank_col or "_rn", F.row_number().over(w))
    out = out.filter(F.col(rank_col or "_rn") <= n)
    return out if rank_col else out.drop("_rn")


def last_n(series: DataFrame, n: int) -> DataFrame:
    """Last ``n`` days of each series (top-n per group, limited before the shuffle)."""
    return top_n(series, ["series_id"], [F.col("ds").desc()], n)


def last_observation(series: DataFrame) -> DataFrame:
    """Last day of each series and its value (which may be NULL if masked)."""
    return series.groupBy("series_id").agg(F.max("ds").alias("ds"),
                                          F.max_by("y", "ds").alias("y"))


def future_frame(series: DataFrame, horizon: int = 30) -> DataFrame:
    """The ``horizon`` days after each series' last day: (series_id, ds, step)."""
    last = series.groupBy("series_id").agg(F.max("ds").alias("_last"))
    steps = F.explode(F.sequence(F.lit(1), F.lit(horizon)))
    return (last.select("series_id", "_last", steps.alias("step"))
            .select("series_id", F.date_add("_last", F.col("step")).alias("ds"), "step"))


def with_anchor(forecast: DataFrame, series: DataFrame) -> DataFrame:
    """Prepend each series' last actual as a zero-width forecast row (step 0)."""
    last = last_observation(series)
    anchor = last.select("series_id", "ds", F.lit(0).alias("step"), F.col("y").alias("yhat"),
                         F.col("y").alias("yhat_lower"), F.col("y").alias("yhat_upper"))
    return anchor.unionByName(forecast.select(*anchor.columns))


def clip_columns(df: DataFrame, cols: Sequence[str] = ("yhat", "yhat_lower", "yhat_upper")):
    """Clip columns at zero, keeping NULL."""
    return df.withColumns({c: clip_at_zero(c) for c in cols})
