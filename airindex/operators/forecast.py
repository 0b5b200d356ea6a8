"""Per-series forecasts with an uncertainty band.

``forecast_linear`` is pure DataFrame: a least-squares trend per series plus a
mean residual per weekday, and a band from residual quantiles. All of it is
window aggregates over one shuffle by ``series_id``, so it scales with the number
of series and is checked against an SQL twin.

``forecast_fourier`` fits trend + weekly/yearly Fourier terms (+ an optional holiday
dummy) per series with numpy ridge least squares inside ``applyInPandas``: each
group is one daily series (bounded by its number of days).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airindex.operators.series import future_frame
from airindex.schemas import FORECAST

DIGITS = 2


def forecast_linear(series: DataFrame, horizon: int = 30, band=(0.1, 0.9)) -> DataFrame:
    """Trend + weekday forecast: (series_id, ds, step, yhat, yhat_lower, yhat_upper)."""
    s = series.filter(F.col("y").isNotNull()).select(
        "series_id", "ds", "y", F.unix_date("ds").cast("double").alias("t"),
        F.weekday("ds").alias("wd"))
    w = Window.partitionBy("series_id")
    wd = Window.partitionBy("series_id", "wd")
    fit = s.withColumns({"b": F.regr_slope("y", "t").over(w),
                         "a": F.regr_intercept("y", "t").over(w)})
    fit = fit.withColumn("r", F.col("y") - (F.col("a") + F.col("b") * F.col("t")))
    fit = fit.withColumn("e", F.avg("r").over(wd))
    fit = fit.withColumn("r2", F.col("r") - F.col("e"))
    fit = fit.withColumns({"lo": F.percentile("r2", band[0]).over(w),
                           "hi": F.percentile("r2", band[1]).over(w)})
    params = fit.groupBy("series_id").agg(F.first("a").alias("a"), F.first("b").alias("b"),
                                         F.first("lo").alias("lo"), F.first("hi").alias("hi"))
    effects = fit.groupBy("series_id", "wd").agg(F.first("e").alias("e"))
    # The horizon starts after the last day of the series, masked (NULL) days included.
    future = future_frame(series, horizon)
    out = (future.withColumn("wd", F.weekday("ds"))
           .join(params, "series_id", "inner")
           .join(effects, ["series_id", "wd"], "left"))
    yhat = (F.col("a") + F.col("b") * F.unix_date("ds").cast("double")
            + F.coalesce(F.col("e"), F.lit(0.0)))
    return out.select("series_id", "ds", "step",
                      F.round(yhat, DIGITS).alias("yhat"),
                      F.round(yhat + F.col("lo"), DIGITS).alias("yhat_lower"),
                      F.round(yhat + F.col("hi"), DIGITS).alias("yhat_upper"))


def _fit_predict(horizon: int, weekly: int, yearly: int, n_changepoints: int, ridge: float,
                 band: tuple[float, float]):
    """The per-series fit as one self-contained closure (numpy and pandas only), so
    executors need nothing from this package to run it."""

    def design(t, changepoints, holiday):
        cols = [np.ones_like(t), t]
        cols += [np.maximum(t - c, 0.0) for c in changepoints]
        for period, order in ((7.0, weekly), (365.25, yearly)):
            for k in range(1, order + 1):
                cols += [np.sin(2 * np.pi * k * t / period), np.cos(2 * np.pi * k * t / period)]
        if holiday is not None:
            cols.append(holiday)
        return np.column_stack(cols)

    def flags(days: pd.Series, holidays):
        if not holidays:
            return None
        return days.dt.date.isin(holidays).to_numpy(dtype=float)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        # Calendar days come as rows of their own beside the series' days.
        off = pdf["holiday"].astype(bool)
        holidays = set(pd.to_datetime(pdf.loc[off, "ds"]).dt.date)
        pdf = pdf.loc[~off, ["series_id", "ds", "y"]]
        all_days = pd.to_datetime(pdf["ds"])
        last_day = all_days.max()
        pdf = pdf.assign(ds=all_days).dropna(subset=["y"]).sort_values("ds")
        if pdf.empty:
            return pd.DataFrame(columns=["series_id", "ds", "step", "yhat", "yhat_lower",
                                         "yhat_upper"])
        t0 = pdf["ds"].iloc[0]
        t = (pdf["ds"] - t0).dt.days.to_numpy(dtype=float)
        y = pdf["y"].to_numpy(dtype=float)
        # Trend changepoints spread over the first 80 % of the history.
        span = t[-1] if len(t) > 1 else 1.0
        cps = np.linspace(0, 0.8 * span, n_changepoints + 2)[1:-1]
        x = design(t, cps, flags(pdf["ds"], holidays))
        scale = float(np.std(y)) or 1.0
        penalty = ridge * np.eye(x.shape[1])
        penalty[0, 0] = penalty[1, 1] = 0.0
        coef = np.linalg.solve(x.T @ x + penalty, x.T @ (y / scale))
        resid = y / scale - x @ coef
        lo, hi = np.quantile(resid, band[0]), np.quantile(resid, band[1])
        steps = np.arange(1, horizon + 1)
        fut_days = pd.Series(last_day + pd.to_timedelta(steps, unit="D"))
        fut_t = (fut_days - t0).dt.days.to_numpy(dtype=float)
        pred = design(fut_t, cps, flags(fut_days, holidays)) @ coef
        return pd.DataFrame({
            "series_id": pdf["series_id"].iloc[0], "ds": fut_days.dt.date,
            "step": steps.astype(np.int32),
            "yhat": pred * scale, "yhat_lower": (pred + lo) * scale,
            "yhat_upper": (pred + hi) * scale})
    return run


def forecast_fourier(series: DataFrame, horizon: int = 30, weekly: int = 3, yearly: int = 10,
                     n_changepoints: int = 25, ridge: float = 1.0, band=(0.1, 0.9),
                     holidays=None) -> DataFrame:
    """Trend with changepoints + weekly/yearly seasonality (+ holiday dummy), per series.

    ``holidays`` is a calendar: dates, or a DataFrame whose first column holds them. Its days
    of a series' own span and horizon are joined to the series as marked rows, so a group holds
    at most its days twice, and nothing is gathered on the driver.
    """
    rows = series.select("series_id", "ds", "y", F.lit(False).alias("holiday"))
    if holidays is not None:
        if not isinstance(holidays, DataFrame):
            holidays = series.sparkSession.createDataFrame([(d,) for d in holidays], "d date")
        calendar = holidays.select(F.col(holidays.columns[0]).cast("date").alias("ds")).distinct()
        spans = (series.groupBy("series_id").agg(F.min("ds").alias("a"), F.max("ds").alias("b"))
                 .select("series_id", F.explode(F.sequence("a", F.date_add("b", horizon))).alias("ds")))
        off = spans.join(calendar, "ds").select("series_id", "ds", F.lit(None).cast("double").alias("y"),
                                                F.lit(True).alias("holiday"))
        rows = rows.union(off)
    fn = _fit_predict(horizon, weekly, yearly, n_changepoints, ridge, band)
    return rows.groupBy("series_id").applyInPandas(fn, FORECAST)
