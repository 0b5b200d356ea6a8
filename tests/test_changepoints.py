"""Sparse-changepoint forecasts against plain refits, and the holiday calendar against known dates."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from airindex.functions.holidays import NAMES, vietnamese_holidays
from airindex.operators.changepoints import (Model, components, fit_changepoints, forecast_changepoints, most_probable,
                                             optimality, solar_calendar, vietnamese_calendar)

SERIES = "series_id string, ds date, y double"
SMALL = Model(holidays=("reunification",), changepoints=8, yearly=2)


def made(days=900, seed=0, kink=None, holiday=0.0, noise=0.5):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(days):
        day = dt.date(2020, 1, 1) + dt.timedelta(days=i)
        y = 50 + 0.02 * i + 3 * math.sin(2 * math.pi * i / 7) + rng.normal(0, noise)
        y += 0.1 * max(i - kink, 0) if kink else 0
        y += holiday if (day.month, day.day) == (4, 30) else 0
        out.append((day, None if i % 50 == 7 else y))
    return out


def frame(spark, **series):
    return spark.createDataFrame([(name, d, y) for name, rows in series.items() for d, y in rows], SERIES)


def design(rows, model):
    """The features by plain Python, row by row."""
    seen = [(d, y) for d, y in rows if y is not None]
    first, days = seen[0][0], max((seen[-1][0] - seen[0][0]).days, 1)
    out = []
    for d, _ in seen:
        u, n = (d - first).days / days, (d - dt.date(1970, 1, 1)).days
        x = [1.0, u] + [max(u - s, 0) for s in model.places]
        for period, order, least in ((7, model.weekly, 14), (365.25, model.yearly, 730)):
            for k in range(1, order + 1):
                x += [f(2 * math.pi * k / period * n) if days >= least else 0.0 for f in (math.sin, math.cos)]
        names = [name for day, name in vietnamese_holidays(d, d)]
        out.append(x + [float(h in names) for h in model.holidays])
    y = np.array([y for _, y in seen])
    return np.array(out), y / max(np.abs(y).max(), 1e-300), np.abs(y).max()


def plain_fit(x, y, model):
    """Coordinate descent on the residuals themselves, one coefficient at a time, to the end."""
    absolute, square = model.penalties()
    b, noise = np.zeros(x.shape[1]), np.var(y) * 0.1 + 1e-9
    norm = (x * x).sum(0)
    r = y.copy()
    for _ in range(60):
        for _ in range(4000):
            moved = 0.0
            for j in np.flatnonzero(norm):
                pull = x[:, j] @ r + norm[j] * b[j]
                new = np.sign(pull) * max(abs(pull) - noise * absolute[j], 0) / (norm[j] + noise * square[j])
                moved = max(moved, abs(new - b[j]) * math.sqrt(norm[j]))
                r -= x[:, j] * (new - b[j])
                b[j] = new
            if moved < 1e-9:
                break
        new_noise = max(float(r @ r) / len(y), 1e-12)
        if abs(new_noise - noise) < 1e-10 * noise:
            break
        noise = new_noise
    return b, math.sqrt(noise)


def test_fit_equals_a_plain_refit(spark):
    rows = {"flat": made(400, 1), "kinked": made(420, 2, kink=250), "off": made(800, 3, holiday=9.0)}
    df = frame(spark, **rows)
    calendar = solar_calendar(df, 30)
    got = {r["series_id"]: r for r in fit_changepoints(df, 30, SMALL, calendar).collect()}
    for name, series in rows.items():
        x, y, scale = design(series, SMALL)
        b, sigma = plain_fit(x, y, SMALL)
        assert got[name]["sigma"] == pytest.approx(sigma, rel=1e-5)
        assert np.abs(x @ np.array(got[name]["coef"]) - x @ b).max() < 2e-5
        assert got[name]["scale"] == pytest.approx(scale)
        # The changepoints that drop out are those of the plain fit.
        assert got[name]["n_changes"] == (np.abs(b[2:2 + SMALL.changepoints]) > 1e-6).sum() < SMALL.changepoints
    effect = got["off"]["coef"][-1] * got["off"]["scale"]
    assert effect == pytest.approx(9.0, abs=1.5) and abs(got["flat"]["coef"][-1] * got["flat"]["scale"]) < 1.5


def test_forecast_follows_a_kink_and_holidays(spark):
    df = frame(spark, a=made(900, 5, kink=450), b=made(820, 6, holiday=20.0))
    calendar = solar_calendar(df, 60)
    out = forecast_changepoints(df, 60, SMALL, calendar).toPandas().sort_values(["series_id", "step"])
    a = out[out.series_id == "a"]
    true = [50 + 0.02 * i + 3 * math.sin(2 * math.pi * i / 7) + 0.1 * (i - 450) for i in range(900, 960)]
    assert np.abs(a.yhat.to_numpy() - true).mean() < 1.5
    width = (a.yhat_upper - a.yhat_lower).to_numpy()
    assert (np.diff(width) >= -1e-9).all() and width[-1] > width[0] * 1.2
    b = out[out.series_id == "b"].set_index("ds").yhat
    day = dt.date(2022, 4, 30)
    assert b[day] - (b[day - dt.timedelta(days=7)] + b[day + dt.timedelta(days=7)]) / 2 > 12
    without = forecast_changepoints(df, 60, SMALL).filter("series_id = 'b'").toPandas().set_index("ds").yhat
    assert abs(without[day] - (without[day - dt.timedelta(days=7)] + without[day + dt.timedelta(days=7)]) / 2) < 3


def test_one_series_over_many_tasks_and_reruns(spark):
    """Stretches of a long series are summed apart; the result does not depend on how rows are dealt out."""
    df = frame(spark, long=made(3000, 8, kink=1500), short=made(20, 9), one=[(dt.date(2020, 1, 1), 5.0)],
               zero=[(dt.date(2020, 1, i), 0.0) for i in range(1, 9)], none=[(dt.date(2020, 1, 1), None)])
    once = forecast_changepoints(df.repartition(1), 10, SMALL).toPandas().sort_values(["series_id", "step"])
    again = forecast_changepoints(df.repartition(13, "ds"), 10, SMALL).toPandas().sort_values(["series_id", "step"])
    assert set(once.series_id) == {"long", "short", "one", "zero"}
    pd.testing.assert_frame_equal(once.reset_index(drop=True), again.reset_index(drop=True), rtol=1e-9)
    assert (once[once.series_id == "zero"].yhat.abs() < 1e-9).all()
    assert once[once.series_id == "one"].yhat.to_numpy() == pytest.approx(5.0, abs=0.2)
    empty = spark.createDataFrame([], SERIES)
    assert forecast_changepoints(empty, 10, SMALL, vietnamese_calendar(empty, 10)).count() == 0


def test_optimality_tells_a_wrong_fit(spark):
    df = frame(spark, a=made(760, 4, kink=300, holiday=5.0))
    calendar = solar_calendar(df, 30)
    fits = fit_changepoints(df, 30, SMALL, calendar)
    assert optimality(df, fits, SMALL, calendar).filter("not optimal").count() == 0
    off = fits.withColumn("coef", F.transform("coef", lambda c, i: F.when(i == SMALL.size - 1, 0.0).otherwise(c)))
    wrong = [r["feature"] for r in optimality(df, off, SMALL, calendar).filter("not optimal").collect()]
    assert SMALL.size - 1 in wrong
    assert optimality(df, fits, SMALL).filter("not optimal").count() > 0  # without the calendar


def test_components_add_up(spark):
    df = frame(spark, a=made(760, 4, holiday=5.0))
    calendar = vietnamese_calendar(df)
    model = Model(holidays=NAMES, changepoints=5, yearly=1)
    fits = fit_changepoints(df, 30, model, calendar)
    out = components(df, fits, model, calendar).select("ds", "holidays", "yhat", (F.col("trend") + F.col("weekly") + F.col("yearly")).alias("rest")).collect()
    off = {d for d, _ in vietnamese_holidays(dt.date(2020, 1, 1), dt.date(2022, 12, 31))}
    assert all((r["holidays"] != 0) == (r["ds"] in off) for r in out)
    assert all(r["yhat"] == pytest.approx(r["rest"] + r["holidays"]) for r in out)


def test_solver_leaves_unused_features_alone():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 6))
    x[:, 5] = 0  # a holiday that never was
    model = Model(holidays=("a",), changepoints=3, weekly=0, yearly=0)
    absolute, square = model.penalties()
    y = 0.4 + 0.3 * x[:, 3]
    b, _ = most_probable(x.T @ x, x.T @ y, float(y @ y), 200, absolute, square)
    assert b[5] == 0 and b[3] == pytest.approx(0.3, abs=0.05)


def test_lunar_calendar_known_dates():
    known = {2004: ("2004-01-22", "2004-04-28"), 2007: ("2007-02-17", "2007-04-26"), 2012: ("2012-01-23", "2012-03-31"),
             2020: ("2020-01-25", "2020-04-02"), 2021: ("2021-02-12", "2021-04-21"), 2022: ("2022-02-01", "2022-04-10"),
             2023: ("2023-01-22", "2023-04-29"), 2024: ("2024-02-10", "2024-04-18"), 2025: ("2025-01-29", "2025-04-07")}
    for year, (tet, hung) in known.items():
        days = {name: d for d, name in vietnamese_holidays(dt.date(year, 1, 1), dt.date(year, 12, 31))}
        assert (days["tet_1"].isoformat(), days["hung_kings"].isoformat()) == (tet, hung)
        assert days["tet_eve"] == days["tet_1"] - dt.timedelta(days=1) and len(days) == len(NAMES)
