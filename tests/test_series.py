"""Series operators and forecasts on hand-made series."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from airindex.operators.forecast import forecast_fourier, forecast_linear
from airindex.operators.series import (clip_columns, future_frame, last_n, last_observation,
                                       mask_outliers, with_anchor)

SCHEMA = "series_id string, ds date, y double"
D0 = dt.date(2024, 1, 1)


def _series(sid, ys):
    return [(sid, D0 + dt.timedelta(days=i), y) for i, y in enumerate(ys)]


def test_mask_outliers_and_anchor_null(spark):
    ys = [1.0] * 99 + [1000.0]
    df = spark.createDataFrame(_series("a", ys), SCHEMA)
    masked = mask_outliers(df, 0.99)
    assert masked.filter(F.col("y").isNull()).count() == 1
    last = last_observation(masked).first()
    assert last.y is None and last.ds == D0 + dt.timedelta(days=99)
    fc = forecast_linear(masked, horizon=3)
    anchored = with_anchor(fc, masked).filter(F.col("step") == 0).first()
    assert anchored.yhat is None


def test_all_null_and_single_point(spark):
    df = spark.createDataFrame([("n", D0, None), ("s", D0, 5.0)], SCHEMA)
    masked = mask_outliers(df, 0.99)
    assert masked.filter(F.col("series_id") == "n").count() == 0
    assert masked.filter(F.col("series_id") == "s").first().y == 5.0
    ff = future_frame(df, 2).orderBy("series_id", "ds").collect()
    assert [(r.series_id, r.step) for r in ff] == [("n", 1), ("n", 2), ("s", 1), ("s", 2)]


def test_last_n(spark):
    df = spark.createDataFrame(_series("a", [float(i) for i in range(10)]), SCHEMA)
    got = sorted(r.y for r in last_n(df, 3).collect())
    assert got == [7.0, 8.0, 9.0]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(-1.0, None, 2.0)], "yhat double, yhat_lower double, "
                                                    "yhat_upper double")
    r = clip_columns(df).first()
    assert (r.yhat, r.yhat_lower, r.yhat_upper) == (0.0, None, 2.0)


def _trend_weekday(n=140):
    ys = []
    for i in range(n):
        d = D0 + dt.timedelta(days=i)
        ys.append(100.0 + 2.0 * i + (10.0 if d.weekday() == 5 else 0.0))
    return ys


def test_linear_forecast_recovers_trend_and_weekday(spark):
    ys = _trend_weekday()
    df = spark.createDataFrame(_series("a", ys), SCHEMA)
    fc = forecast_linear(df, horizon=7).orderBy("ds").collect()
    for r in fc:
        i = (r.ds - D0).days
        expected = 100.0 + 2.0 * i + (10.0 if r.ds.weekday() == 5 else 0.0)
        assert abs(r.yhat - expected) < 2.0
        assert r.yhat_lower <= r.yhat <= r.yhat_upper


def test_fourier_forecast_error_bound(spark):
    ys = _trend_weekday(200)
    rng = np.random.default_rng(0)
    noisy = [y + float(e) for y, e in zip(ys, rng.normal(0, 1, len(ys)))]
    df = spark.createDataFrame(_series("a", noisy) + _series("b", [1.0] * 30), SCHEMA)
    fc = forecast_fourier(df, horizon=14).filter(F.col("series_id") == "a").collect()
    assert len(fc) == 14
    errs = []
    for r in fc:
        i = (r.ds - D0).days
        errs.append(abs(r.yhat - (100.0 + 2.0 * i + (10.0 if r.ds.weekday() == 5 else 0.0))))
    assert max(errs) < 8.0


def test_fourier_matches_direct_fit_per_series(spark):
    """Brute force on the given tables: each series' forecast equals the same fit run
    directly (pandas + numpy, no Spark) on that series' rows."""
    import pandas as pd
    from airindex.operators.forecast import _fit_predict
    from airindex.plans.queries_series import masked_series
    from tests.conftest import SF001
    series = masked_series(spark, SF001)
    got = forecast_fourier(series, horizon=5).toPandas()
    local = series.toPandas().assign(holiday=False)
    fn = _fit_predict(5, 3, 10, 25, 1.0, (0.1, 0.9))
    for sid, pdf in local.groupby("series_id"):
        want = fn(pdf.reset_index(drop=True))
        mine = got[got.series_id == sid].sort_values("step").reset_index(drop=True)
        assert list(mine["ds"]) == list(want["ds"])
        for c in ("yhat", "yhat_lower", "yhat_upper"):
            assert np.allclose(mine[c].to_numpy(), want[c].to_numpy(), rtol=1e-9, atol=1e-6)
    assert len(got) == 5 * local["series_id"].nunique()
    assert isinstance(local, pd.DataFrame)


def test_fourier_learns_holiday_effect(spark):
    days = [D0 + dt.timedelta(days=i) for i in range(200)]
    hol = [d for d in days if d.day == 1] + [D0 + dt.timedelta(days=201)]
    ys = [50.0 + (40.0 if d in hol else 0.0) for d in days]
    df = spark.createDataFrame([("h", d, y) for d, y in zip(days, ys)], SCHEMA)
    cal = spark.createDataFrame([(d,) for d in hol], "holiday date")
    fc = {r.ds: r.yhat for r in forecast_fourier(df, horizon=3, holidays=cal).collect()}
    assert fc[D0 + dt.timedelta(days=201)] - fc[D0 + dt.timedelta(days=200)] > 25.0
