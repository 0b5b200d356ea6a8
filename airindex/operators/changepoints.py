"""Sparse-changepoint forecasts: piecewise-linear trend, seasonality, holidays, a widening band.

The model of a series, with time ``u`` scaled to 0..1 over its history and values to -1..1::

    y = m + k u + sum_j delta_j max(u - s_j, 0) + weekly and yearly Fourier terms + holiday effects

``delta`` has a Laplace prior (scale ``changepoint_prior``), so most changepoints drop out; seasonal and
holiday effects have normal priors (``seasonality_prior``, ``holidays_prior``). The fit is the most probable
one, noise included.

Work is split so that no task needs a whole series' rows. The features of a row are plain columns. Stretches
of a series' days give sufficient statistics (feature products, summed in one numpy product per stretch); what
a series' solver gets is one such row per stretch, at most ``STRETCH`` days each, however many series or days
there are. The solver is coordinate descent, finished on its active set by a linear system, and prediction is a
column expression again. The band is simulated: past changepoints' rate and size go on in the future, so it
widens with the horizon, and noise is added; the seed is the series' name, so reruns agree.
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airindex.functions import holidays as holiday_rules
from airindex.operators.series import future_frame

# Task functions travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(holiday_rules)

WEEK, YEAR = 7.0, 365.25
STRETCH = 512
PARTIAL = "series_id string, stretch int, n long, yy double, xy array<double>, xx array<double>"
FITTED = ("series_id string, coef array<double>, sigma double, n_changes int, low array<double>, high array<double>")


@dataclass(frozen=True)
class Model:
    """What a forecast is made of. The two prior scales are the reference model's."""

    holidays: tuple[str, ...] = ()
    changepoints: int = 25
    changepoint_range: float = 0.8
    weekly: int = 3
    yearly: int = 10
    changepoint_prior: float = 0.1
    seasonality_prior: float = 10.0
    holidays_prior: float = 10.0
    growth_prior: float = 5.0  # of offset and slope
    band: tuple[float, float] = (0.1, 0.9)
    samples: int = 1000

    @property
    def places(self) -> list[float]:
        """The changepoints' scaled times."""
        return [self.changepoint_range * j / (self.changepoints + 1) for j in range(1, self.changepoints + 1)]

    @property
    def parts(self) -> dict[str, tuple[int, int]]:
        """Which coefficients are trend, weekly, yearly and holiday effects: [first, end)."""
        out, at = {}, 0
        for name, n in (("trend", 2 + self.changepoints), ("weekly", 2 * self.weekly), ("yearly", 2 * self.yearly),
                        ("holidays", len(self.holidays))):
            out[name] = (at, at + n)
            at += n
        return out

    @property
    def size(self) -> int:
        return self.parts["holidays"][1]

    def penalties(self) -> tuple[np.ndarray, np.ndarray]:
        """(weight of the absolute value, weight of half the square) of every coefficient."""
        absolute, square = np.zeros(self.size), np.zeros(self.size)
        square[:2] = self.growth_prior ** -2
        absolute[2: 2 + self.changepoints] = 1 / self.changepoint_prior
        first, end = self.parts["holidays"]
        square[2 + self.changepoints: first] = self.seasonality_prior ** -2
        square[first:end] = self.holidays_prior ** -2
        return absolute, square


def spans(series: DataFrame) -> DataFrame:
    """series_id, first (day), days (of history, at least 1), scale (largest absolute value) of observed values."""
    seen = series.filter(F.col("y").isNotNull())
    return seen.groupBy("series_id").agg(F.min("ds").alias("first"), F.max("ds").alias("_last"), F.max(F.abs("y")).alias("scale")).select(
        "series_id", "first", F.greatest(F.datediff("_last", "first"), F.lit(1)).alias("days"),
        F.when(F.col("scale") > 0, F.col("scale")).otherwise(1.0).alias("scale"))


def features(model: Model, off: Column | None = None) -> Column:
    """The row's features: array<double>, in the order of ``Model.parts``.

    Needs ``ds``, ``first`` and ``days``; ``off``: the array of holiday names of the day. A season that
    the history is too short for (two weeks, two years) has features of 0.
    """
    day = F.unix_date("ds").cast("double")
    u = F.datediff("ds", "first") / F.col("days")
    out = [F.lit(1.0), u] + [F.greatest(u - s, F.lit(0.0)) for s in model.places]
    for period, order, least in ((WEEK, model.weekly, 14), (YEAR, model.yearly, 730)):
        for k in range(1, order + 1):
            angle = day * (2 * math.pi * k / period)
            out += [F.when(F.col("days") >= least, wave(angle)).otherwise(0.0) for wave in (F.sin, F.cos)]
    none = F.array().cast("array<string>")
    out += [F.when(F.array_contains(F.coalesce(off, none), name), 1.0).otherwise(0.0) for name in model.holidays] if off is not None else \
        [F.lit(0.0) for _ in model.holidays]
    return F.array(*out)


def with_features(rows: DataFrame, spans_: DataFrame, model: Model, calendar: DataFrame | None) -> DataFrame:
    """rows (series_id, ds, ...) with their series' span and ``x``, the features."""
    out = rows.join(spans_, "series_id")
    if calendar is None or not model.holidays:
        return out.withColumn("x", features(model))
    days = calendar.groupBy("ds").agg(F.collect_set("holiday").alias("off"))
    return out.join(days, "ds", "left").withColumn("x", features(model, F.col("off"))).drop("off")


def stretch_statistics(rows: DataFrame, model: Model) -> DataFrame:
    """Sufficient statistics per series and stretch of STRETCH days: n, yy, xy[i], xx[i * size + j], y scaled."""
    size = model.size
    stretch = F.floor(F.datediff("ds", "first") / STRETCH).cast("int")
    dealt = (rows.filter(F.col("y").isNotNull())
             .select(F.col("series_id").cast("string").alias("series_id"), stretch.alias("stretch"), "ds", (F.col("y") / F.col("scale")).alias("y"), "x")
             .repartition("series_id", "stretch").sortWithinPartitions("series_id", "stretch", "ds"))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []  # the stretch that is not over yet: (key, [y], [x])

        def out(key, ys, xs):
            y, x = np.concatenate(ys), np.concatenate(xs)
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]]), pa.array([key[1]], pa.int32()), pa.array([len(y)], pa.int64()), pa.array([float(y @ y)]),
                 pa.array([(x.T @ y).tolist()]), pa.array([(x.T @ x).ravel().tolist()])], ["series_id", "stretch", "n", "yy", "xy", "xx"])

        for batch in batches:
            y = batch.column("y").to_numpy()
            x = batch.column("x").flatten().to_numpy().reshape(-1, size)
            keys = list(zip(batch.column("series_id").to_pylist(), batch.column("stretch").to_pylist(), strict=True))
            edges = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if held and held[0] != keys[a]:
                    yield out(*held)
                    held = []
                if not held:
                    held = [keys[a], [], []]
                held[1].append(y[a:b])
                held[2].append(x[a:b])
        if held:
            yield out(*held)

    return dealt.select("series_id", "stretch", "y", "x").mapInArrow(sums, PARTIAL)


def most_probable(xx: np.ndarray, xy: np.ndarray, yy: float, n: int, absolute: np.ndarray, square: np.ndarray) -> tuple[np.ndarray, float]:
    """(coefficients, noise variance) that minimise RSS / (2 s) + n/2 log s + absolute |b| + square b^2 / 2."""
    size = len(xy)
    used = np.diag(xx) > 0

    def rss(b):
        return max(float(yy - 2 * b @ xy + b @ xx @ b), 1e-12 * max(yy, 1e-12))

    def given(noise: float, b: np.ndarray) -> np.ndarray:
        l1, l2 = noise * absolute, noise * square
        sparse = np.flatnonzero(used & (absolute > 0))
        free = used & (absolute == 0)
        for _ in range(200):
            # Coordinate descent over the sparse ones, with the free ones solved exactly in between.
            for _ in range(20):
                rest = np.flatnonzero(free)
                b[rest] = np.linalg.solve(xx[np.ix_(rest, rest)] + np.diag(l2[rest]), xy[rest] - xx[np.ix_(rest, sparse)] @ b[sparse])
                for j in sparse:
                    pull = xy[j] - xx[j] @ b + xx[j, j] * b[j]
                    b[j] = np.sign(pull) * max(abs(pull) - l1[j], 0.0) / xx[j, j]
            # On these signs the optimum is a linear system; done if it keeps them and nobody else moves.
            sign = np.sign(b) * (absolute > 0)
            act = np.flatnonzero(free | (sign != 0))
            exact = np.zeros(size)
            exact[act] = np.linalg.solve(xx[np.ix_(act, act)] + np.diag(l2[act]), xy[act] - l1[act] * sign[act])
            slope = xy - xx @ exact
            idle = used & (absolute > 0) & (sign == 0)
            if (np.sign(exact[sign != 0]) == sign[sign != 0]).all() and (np.abs(slope[idle]) <= l1[idle] * (1 + 1e-9) + 1e-12).all():
                return exact
        return b

    ridge = np.zeros(size)
    at = np.flatnonzero(used)
    ridge[at] = np.linalg.solve(xx[np.ix_(at, at)] + np.diag(1e-6 + square[at]), xy[at])
    noise, b = rss(ridge) / n, np.zeros(size)
    for _ in range(50):
        b = given(noise, b.copy())
        new = rss(b) / n
        if abs(new - noise) <= 1e-13 * noise:
            break
        noise = new
    return b, noise


def simulated_band(seed: int, delta: np.ndarray, sigma: float, days: float, horizon: int, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Band around the forecast per step: new changepoints at the past rate and mean size, and noise."""
    rng = np.random.default_rng(seed)
    changes = rng.poisson(model.changepoints / days, (model.samples, horizon))
    size = float(np.abs(delta).mean()) if len(delta) else 0.0
    jump = (rng.standard_gamma(changes) - rng.standard_gamma(changes)) * size  # sums of that many Laplace draws
    drift = np.cumsum(np.cumsum(jump, axis=1), axis=1) / days
    # One noise per sample for all steps, so that steps differ by the trend alone.
    low, high = np.quantile(drift + rng.normal(0.0, sigma, (model.samples, 1)), model.band, axis=0)
    # Uncertainty only grows; where a sampled quantile narrows, that is sampling error.
    return np.minimum.accumulate(np.minimum(low, 0.0)), np.maximum.accumulate(np.maximum(high, 0.0))


def fit_changepoints(series: DataFrame, horizon: int = 30, model: Model = Model(), calendar: DataFrame | None = None) -> DataFrame:
    """A row per series: its span, ``coef``, ``sigma``, ``n_changes`` (changepoints that stay), ``low`` and
    ``high`` (the band per step); all scaled. A series without any value has no row."""
    span = spans(series)
    partial = stretch_statistics(with_features(series.select("series_id", "ds", "y"), span, model, calendar), model)
    size, cut = model.size, 2 + model.changepoints
    absolute, square = model.penalties()

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("stretch")  # one order of summing, however the rows came
        xx = np.sum(np.stack(rows["xx"].to_list()), axis=0).reshape(size, size)
        xy = np.sum(np.stack(rows["xy"].to_list()), axis=0)
        b, noise = most_probable(xx, xy, float(rows["yy"].sum()), int(rows["n"].sum()), absolute, square)
        name = str(rows["series_id"].iloc[0])
        low, high = simulated_band(zlib.crc32(name.encode()), b[2:cut], math.sqrt(noise), float(rows["days"].iloc[0]), horizon, model)
        return pd.DataFrame({"series_id": [name], "coef": [b], "sigma": [math.sqrt(noise)],
                             "n_changes": [int((b[2:cut] != 0).sum())], "low": [low], "high": [high]})

    days = span.select(F.col("series_id").cast("string").alias("series_id"), "days")
    fits = partial.join(days, "series_id").groupBy("series_id").applyInPandas(solve, FITTED)
    key = span.schema["series_id"].dataType
    return span.join(fits.withColumn("series_id", F.col("series_id").cast(key)), "series_id")


def _dot(first: int, end: int) -> Column:
    if first == end:
        return F.lit(0.0)
    products = F.zip_with(F.slice("x", first + 1, end - first), F.slice("coef", first + 1, end - first), lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda s, p: s + p) * F.col("scale")


def components(rows: DataFrame, fits: DataFrame, model: Model = Model(), calendar: DataFrame | None = None) -> DataFrame:
    """rows (series_id, ds, ...) with trend, weekly, yearly, holidays and their sum, yhat."""
    own = fits.select("series_id", "first", "days", "scale", "coef", "sigma", "low", "high")
    out = with_features(rows, own, model, calendar)
    out = out.select(*rows.columns, *[_dot(*part).alias(name) for name, part in model.parts.items()], "scale", "sigma", "low", "high", "x", "coef")
    return out.withColumn("yhat", F.col("trend") + F.col("weekly") + F.col("yearly") + F.col("holidays"))


def forecast_changepoints(series: DataFrame, horizon: int = 30, model: Model = Model(), calendar: DataFrame | None = None,
                          fits: DataFrame | None = None) -> DataFrame:
    """(series_id, ds, step, yhat, yhat_lower, yhat_upper) of the days after each series' last one.

    ``calendar``: (ds, holiday) rows; holidays that ``model`` does not name are left out.
    """
    fits = fit_changepoints(series, horizon, model, calendar) if fits is None else fits
    out = components(future_frame(series, horizon), fits, model, calendar)
    step = lambda side: F.get(side, F.col("step") - 1) * F.col("scale")
    return out.select("series_id", "ds", "step", "yhat", (F.col("yhat") + step("low")).alias("yhat_lower"),
                      (F.col("yhat") + step("high")).alias("yhat_upper"))


def optimality(series: DataFrame, fits: DataFrame, model: Model = Model(), calendar: DataFrame | None = None,
               tolerance: float = 1e-6) -> DataFrame:
    """(series_id, feature, optimal): whether the fit could gain by changing one coefficient, from the rows.

    The slope of the misfit along each feature is summed from the series' own rows (not the solver's
    statistics): a coefficient in use must balance it against its prior, an unused one must be outweighed.
    """
    absolute, square = model.penalties()
    at = components(series.filter(F.col("y").isNotNull()).select("series_id", "ds", "y"), fits, model, calendar)
    weights = F.array(*[F.struct(F.lit(float(a)).alias("l1"), F.lit(float(s)).alias("l2")) for a, s in zip(absolute, square, strict=True)])
    rows = at.select("series_id", "sigma", ((F.col("y") - F.col("yhat")) / F.col("scale")).alias("r"),
                     F.posexplode(F.arrays_zip("x", "coef", weights.alias("w"))).alias("feature", "f"))
    sums = rows.groupBy("series_id", "feature").agg(
        F.sum(F.col("r") * F.col("f.x")).alias("slope"), F.sqrt(F.sum(F.col("f.x") ** 2) * F.count("*")).alias("room"),
        F.max("f.coef").alias("coef"), F.max("sigma").alias("sigma"), F.max("f.w.l1").alias("l1"), F.max("f.w.l2").alias("l2"))
    noise = F.col("sigma") ** 2
    left = F.col("slope") - noise * (F.col("l2") * F.col("coef") + F.col("l1") * F.signum("coef"))
    slack = F.lit(tolerance) * (F.col("room") + 1)
    unused = (F.col("coef") == 0) & (F.col("l1") > 0)
    return sums.select("series_id", "feature", F.when(unused, F.abs("slope") <= noise * F.col("l1") + slack).otherwise(F.abs(left) <= slack).alias("optimal"))


def _years(series: DataFrame, horizon: int) -> DataFrame:
    """(first, last, year): the span of all series and their horizon, a row per year it touches."""
    span = series.agg(F.min("ds").alias("first"), F.date_add(F.max("ds"), horizon).alias("last")).filter("first IS NOT NULL")
    return span.select("first", "last", F.explode(F.sequence(F.year("first"), F.year("last"))).alias("year"))


def vietnamese_calendar(series: DataFrame, horizon: int = 30) -> DataFrame:
    """(ds, holiday): Vietnam's public holidays, lunar ones included, over the series' span and horizon."""
    def days(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [row for first, last, year in frame.itertuples(index=False)
                    for row in holiday_rules.vietnamese_holidays(max(first, dt.date(year, 1, 1)), min(last, dt.date(year, 12, 31)))]
            yield pd.DataFrame(rows, columns=["ds", "holiday"])

    return _years(series, horizon).mapInPandas(days, "ds date, holiday string")


def solar_calendar(series: DataFrame, horizon: int = 30) -> DataFrame:
    """(ds, holiday): the holidays with a fixed date, by columns alone."""
    days = F.array(*[F.struct(F.lit(name).alias("holiday"), F.make_date("year", F.lit(month), F.lit(day)).alias("ds"))
                     for name, (month, day) in holiday_rules.SOLAR.items()])
    return (_years(series, horizon).select("first", "last", F.explode(days).alias("d"))
            .filter(F.col("d.ds").between(F.col("first"), F.col("last"))).select("d.ds", "d.holiday"))
