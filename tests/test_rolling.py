"""Rolling ozone windows: minimum counts, midnight halo, gaps, locations, ranges."""

import datetime as dt

from pyspark.sql import functions as F

from airindex.operators.rolling import rolling_rows, rolling_seconds
from airindex.plans.daily import daily_air_index

SCHEMA = "location_id int, measured_at timestamp, measure_date date, o3 double"


def _rows(loc, start, hours, values):
    out = []
    for h, v in zip(hours, values):
        ts = start + dt.timedelta(hours=h)
        out.append((loc, ts, ts.date(), v))
    return out


def _collect(df, col="rolling_o3"):
    return {(r.location_id, r.measured_at): (r[col], r.count_o3) for r in df.collect()}


def test_counts_and_nulls(spark):
    t0 = dt.datetime(2024, 1, 1, 0)
    vals = [1.0, None, 3.0, None, 5.0, 6.0, None, 8.0, 9.0]
    df = spark.createDataFrame(_rows(1, t0, range(9), vals), SCHEMA)
    got = _collect(rolling_rows(df, "o3"))
    last = got[(1, t0 + dt.timedelta(hours=8))]
    # rows 1..8: values 3,5,6,8,9 (+ None x3) -> 5 non-null
    assert last == (round((3 + 5 + 6 + 8 + 9) / 5, 10), 5)
    assert got[(1, t0 + dt.timedelta(hours=7))][1] == 5  # 1,3,5,6,8


def test_window_crosses_midnight_but_not_two_days(spark):
    d1 = dt.datetime(2024, 1, 1, 20)
    rows = _rows(1, d1, range(8), [float(i) for i in range(8)])  # 20:00 .. 03:00 next day
    df = spark.createDataFrame(rows, SCHEMA)
    got = _collect(rolling_rows(df, "o3"))
    # 03:00 on Jan 2 sees Jan 1 20:00..23:00 (halo) and Jan 2 00:00..03:00
    assert got[(1, dt.datetime(2024, 1, 2, 3))] == (3.5, 8)
    # A row on Jan 3 must not see Jan 1 (the reference reads D-1 and D only).
    rows3 = rows + _rows(1, dt.datetime(2024, 1, 3, 0), [0], [100.0])
    got3 = _collect(rolling_rows(spark.createDataFrame(rows3, SCHEMA), "o3"))
    # Jan 2 00:00..03:00 (4, 5, 6, 7) and itself; Jan 1 rows are out of reach.
    assert got3[(1, dt.datetime(2024, 1, 3, 0))] == ((4 + 5 + 6 + 7 + 100) / 5, 5)


def test_rows_vs_hours_with_gap(spark):
    t0 = dt.datetime(2024, 1, 1, 0)
    hours = [0, 1, 2, 8, 9]  # 5-hour gap
    df = spark.createDataFrame(_rows(1, t0, hours, [1.0, 2.0, 3.0, 4.0, 5.0]), SCHEMA)
    by_rows = _collect(rolling_rows(df, "o3"))
    by_hours = _collect(rolling_seconds(df, "o3", 8 * 3600))
    at9 = (1, t0 + dt.timedelta(hours=9))
    assert by_rows[at9] == (3.0, 5)          # last 8 rows: all five
    assert by_hours[at9] == (4.0, 3)         # 02:00..09:00 only: hours 2, 8, 9


def test_locations_do_not_mix(spark):
    t0 = dt.datetime(2024, 1, 1, 0)
    rows = _rows(1, t0, range(4), [1.0] * 4) + _rows(2, t0, range(4), [9.0] * 4)
    got = _collect(rolling_rows(spark.createDataFrame(rows, SCHEMA), "o3"))
    assert all(v == (1.0, k[1].hour + 1) for k, v in got.items() if k[0] == 1)
    assert all(v[0] == 9.0 for k, v in got.items() if k[0] == 2)


def test_range_equals_day_by_day(spark):
    from airindex.sources.tables import readings
    from tests.conftest import SF01
    r = readings(spark, SF01).cache()
    whole = daily_air_index(r, "2024-01-10", "2024-01-14")
    parts = None
    for d in range(10, 15):
        day = dt.date(2024, 1, d)
        one = daily_air_index(r, day, day)
        parts = one if parts is None else parts.unionByName(one)
    assert whole.count() == parts.count() == 40
    assert whole.exceptAll(parts).count() == 0
    assert parts.exceptAll(whole).count() == 0
    # The whole history in one job gives the same rows for those days.
    full = daily_air_index(r).filter(F.col("measure_date").between("2024-01-10", "2024-01-14"))
    assert full.exceptAll(whole).count() == 0
    r.unpersist()


def test_hours_window_equals_full_history_window(spark):
    from pyspark.sql import Window
    from airindex.functions.exact import exact_window_mean
    from airindex.sources.tables import readings
    from tests.conftest import SF01
    r = readings(spark, SF01).select("location_id", "measured_at", "measure_date", "o3")
    ours = rolling_seconds(r, "o3", 8 * 3600)
    w = (Window.partitionBy("location_id").orderBy(F.unix_timestamp("measured_at"))
         .rangeBetween(-7 * 3600, 0))
    brute = r.withColumns({"rolling_o3": exact_window_mean("o3", w),
                           "count_o3": F.count("o3").over(w)})
    assert ours.exceptAll(brute.select(*ours.columns)).count() == 0


def test_rolling_mean_min_count(spark):
    from airindex.operators.rolling import rolling_mean
    t0 = dt.datetime(2024, 1, 1, 0)
    vals = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0]
    df = spark.createDataFrame(_rows(1, t0, range(7), vals), SCHEMA)
    got = _collect(rolling_mean(df, "o3", min_count=6))
    assert got[(1, t0 + dt.timedelta(hours=4))] == (None, 5)
    assert got[(1, t0 + dt.timedelta(hours=5))] == (3.5, 6)
    by_time = _collect(rolling_mean(df, "o3", seconds=3 * 3600, min_count=2))
    assert by_time[(1, t0)] == (None, 1)
    assert by_time[(1, t0 + dt.timedelta(hours=6))] == (6.0, 3)


def test_month_buckets_match_brute_force(spark):
    """Random hourly readings with gaps over several month ends, two locations:
    the row window equals 'last 8 rows of day D-1 and D', the time window equals a
    window over the whole history."""
    import random
    rng = random.Random(7)
    rows = []
    start = dt.datetime(2024, 1, 28)
    for loc in (1, 2):
        t = start
        while t < dt.datetime(2024, 3, 3):
            if rng.random() < 0.7:  # gaps: about 30 % of hours missing
                v = None if rng.random() < 0.2 else round(rng.uniform(0, 300), 2)
                rows.append((loc, t, t.date(), v))
            t += dt.timedelta(hours=rng.choice([1, 1, 1, 2, 5]))
    df = spark.createDataFrame(rows, SCHEMA)
    got_rows = _collect(rolling_rows(df, "o3"))
    got_time = _collect(rolling_seconds(df, "o3", 8 * 3600))
    by_loc = {}
    for r in rows:
        by_loc.setdefault(r[0], []).append(r)
    for loc, rs in by_loc.items():
        rs.sort(key=lambda r: r[1])
        for i, (_, ts, day, _) in enumerate(rs):
            buf = [r for r in rs[:i + 1] if r[2] >= day - dt.timedelta(days=1)][-8:]
            vals = [r[3] for r in buf if r[3] is not None]
            mean, count = got_rows[(loc, ts)]
            assert count == len(vals)
            if vals:
                assert abs(mean - sum(vals) / len(vals)) < 1e-9
            else:
                assert mean is None
            win = [r[3] for r in rs[:i + 1] if r[1] > ts - dt.timedelta(hours=8)]
            tv = [v for v in win if v is not None]
            mean_t, count_t = got_time[(loc, ts)]
            assert count_t == len(tv)
            if tv:
                assert abs(mean_t - sum(tv) / len(tv)) < 1e-9


def test_range_starting_on_first_of_month(spark):
    t0 = dt.datetime(2024, 1, 30, 0)
    rows = [(1, t0 + dt.timedelta(hours=h), (t0 + dt.timedelta(hours=h)).date(),
             float(h % 50), 10.0, 20.0) for h in range(0, 24 * 4)]
    df = spark.createDataFrame(rows, SCHEMA + ", pm2_5 double, pm10 double")
    full = df.withColumns({"aqi_level": F.lit(2), "co": F.lit(1.0), "no": F.lit(1.0),
                           "no2": F.lit(1.0), "so2": F.lit(1.0), "nh3": F.lit(1.0)})
    whole = daily_air_index(full).filter(F.col("measure_date") >= "2024-02-01")
    ranged = daily_air_index(full, "2024-02-01", "2024-02-02")
    assert ranged.count() == 2
    assert whole.exceptAll(ranged).count() == 0 and ranged.exceptAll(whole).count() == 0


def test_max_8h_needs_six_values(spark):
    from airindex.operators.rollup import daily_rollup
    t0 = dt.datetime(2024, 1, 1, 0)
    # hours 0..7 with o3 values; NULLs make the window counts 5, 6 and 8 at chosen hours
    vals = [100.0, None, None, None, 10.0, 10.0, 10.0, 10.0, 10.0, 10.0]
    rows = [(1, t0 + dt.timedelta(hours=h), t0.date(), v) for h, v in enumerate(vals)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns(
        {c: F.lit(1.0) for c in ("pm2_5", "pm10", "co", "no2", "so2", "no", "nh3")}
    ).withColumn("aqi_level", F.lit(2))
    rolled = rolling_rows(df, "o3")
    counts = {r.measured_at.hour: r.count_o3 for r in rolled.collect()}
    assert counts[4] == 2 and counts[6] == 4 and counts[7] == 5 and counts[8] == 5
    assert counts[9] == 6
    day = daily_rollup(rolled).first()
    # hours with >= 6 values: only hour 9 (window 2..9: six 10.0 values) -> 10.0; the
    # 100.0 at hour 0 only reaches windows with fewer than 6 values
    assert day.max_8h_o3 == 10.0
    df8 = spark.createDataFrame([(1, t0 + dt.timedelta(hours=h), t0.date(), 100.0 + h)
                                 for h in range(8)], SCHEMA)
    last = {r.measured_at.hour: (r.rolling_o3, r.count_o3)
            for r in rolling_rows(df8, "o3").collect()}[7]
    assert last == (103.5, 8)
