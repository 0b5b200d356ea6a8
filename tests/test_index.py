"""Piecewise index, ozone combination, labels, quality gate (hand-made edge cases)."""

import pytest
from pyspark.sql import functions as F

from airindex.functions.index import (CO, NO2, O3_1H, O3_8H, PM2_5, PM10, SO2, SUB_INDEXES,
                                      dominant_pollutant, ozone_index, piecewise_index)
from airindex.functions.labels import (health_label, is_hazardous, level_label,
                                       quality_status)

TABLES = {"pm25": PM2_5, "pm10": PM10, "co": CO, "no2": NO2, "so2": SO2, "o3_1h": O3_1H,
          "o3_8h": O3_8H}


def _index(spark, values, segments, **kw):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = df.select("x", piecewise_index("x", segments, **kw).alias("i")).collect()
    return {r.x: r.i for r in rows}


def _reference_index(x, segments, clamp=False):
    """Plain-Python statement of the rule, for comparison."""
    if x is None:
        return 0
    for lo, hi, i_lo, i_hi in segments:
        if lo <= x <= hi:
            return int((i_hi - i_lo) / (hi - lo) * (x - lo) + i_lo)
    if clamp and x > segments[-1][1]:
        return segments[-1][3]
    return 0


@pytest.mark.parametrize("name", sorted(TABLES))
def test_boundaries_each_table(spark, name):
    segs = TABLES[name]
    values = []
    for lo, hi, _, _ in segs:
        values += [float(lo), float(hi), hi + 0.01, lo + 0.01]
    values += [-1.0, segs[-1][1] + 0.01]
    got = _index(spark, values, segs)
    for v in values:
        assert got[v] == _reference_index(v, segs), (name, v)


def test_documented_values(spark):
    got = _index(spark, [25.0, 25.01, 50.01, -1.0, 500.01], PM2_5)
    assert got[25.0] == 50          # shared boundary: lower segment wins
    assert got[25.01] == 51
    assert got[50.01] == 101
    assert got[-1.0] == 0
    assert got[500.01] == 0         # off scale -> 0 by default
    clamped = _index(spark, [500.01], PM2_5, off_scale="clamp")
    assert clamped[500.01] == 500


def test_null_and_truncation(spark):
    df = spark.createDataFrame([(None,), (25.495,)], "x double")
    rows = df.select(piecewise_index("x", PM2_5).alias("a"),
                     piecewise_index("x", PM2_5, null_to_zero=False).alias("b")).collect()
    assert rows[0].a == 0 and rows[0].b is None
    assert rows[1].a == 51  # 51 + 49/25 * 0.495 = 51.97 truncates to 51


def test_ozone_combination(spark):
    data = [(400.0, 300, 200), (400.01, 300, 200), (None, 150, 0), (100.0, 20, 45)]
    df = spark.createDataFrame(data, "m8 double, i1 int, i8 int")
    got = [r.o for r in df.select(ozone_index("i1", "i8", "m8").alias("o")).collect()]
    assert got == [300, 300, 150, 45]
    df2 = spark.createDataFrame([(400.01, 100, 200)], "m8 double, i1 int, i8 int")
    assert df2.select(ozone_index("i1", "i8", "m8")).first()[0] == 100


def test_level_labels(spark):
    df = spark.createDataFrame([(v,) for v in [0, 1, 2, 3, 4, 5, 6, None]], "l int")
    got = [r[0] for r in df.select(level_label("l")).collect()]
    assert got == ["Unknown", "Good", "Fair", "Moderate", "Poor", "Very Poor", "Unknown",
                   "Unknown"]


def test_health_labels_and_hazard(spark):
    vals = [50, 51, 100, 101, 150, 151, 200, 201, 300, 301, None]
    df = spark.createDataFrame([(v,) for v in vals], "i int")
    rows = df.select(health_label("i").alias("h"), is_hazardous("i").alias("z")).collect()
    assert [r.h for r in rows] == ["Good", "Moderate", "Moderate", "Poor", "Poor", "Unhealthy",
                                   "Unhealthy", "Very Unhealthy", "Very Unhealthy",
                                   "Hazardous", "N/A"]
    assert [r.z for r in rows] == [False] * 7 + [True] * 3 + [False]


def test_quality_status_truth_table(spark):
    rows = []
    for count in (17, 18, 24):
        for pm25, pm10 in ((1.0, 1.0), (1.0, None), (None, 1.0), (None, None)):
            rows.append((count, pm25, pm10))
    df = spark.createDataFrame(rows, "c int, a double, b double")
    got = [r[0] for r in df.select(quality_status("c", "a", "b")).collect()]
    expected = []
    for count, pm25, pm10 in rows:
        if count >= 18 and (pm25 is not None or pm10 is not None):
            expected.append("Valid")
        elif pm25 is None and pm10 is None:
            expected.append("Missing PM Data")
        else:
            expected.append("Insufficient Data (<75%)")
    assert got == expected
    assert set(got) == {"Valid", "Missing PM Data", "Insufficient Data (<75%)"}


def test_dominant_pollutant_ties(spark):
    names = ["aqi_pm25", "aqi_pm10", "aqi_co", "aqi_no2", "aqi_so2", "aqi_o3"]
    rows = [
        (10, 10, [10, 10, 10, 10, 10, 10]),   # all tied -> PM2.5
        (20, 20, [0, 20, 20, 0, 0, 0]),       # PM10/CO tie -> PM10
        (30, 30, [0, 0, 0, 30, 30, 0]),       # NO2/SO2 tie -> NO2
        (0, 0, [0, 0, 0, 0, 0, 0]),           # all zero -> PM2.5
        (None, 40, [0, 0, 0, 0, 0, 40]),      # NULL index -> NULL
        (40, 40, [0, 0, 0, 0, 0, 40]),        # only ozone -> Ozone
    ]
    data = [(a, b, *parts) for a, b, parts in rows]
    df = spark.createDataFrame(data, "vn int, raw int, " + ", ".join(f"{n} int" for n in names))
    got = [r[0] for r in df.select(dominant_pollutant("vn", "raw")).collect()]
    assert got == ["PM2.5", "PM10", "NO2", "PM2.5", None, "Ozone"]


def test_sub_index_inputs_are_fact_columns():
    assert {src for src, _ in SUB_INDEXES.values()} == {
        "avg_pm2_5", "avg_pm10", "max_1h_co", "max_1h_no2", "max_1h_so2", "max_1h_o3",
        "max_8h_o3"}


@pytest.mark.parametrize("name", sorted(TABLES))
def test_monotone_on_scale(spark, name):
    from hypothesis import given, settings, strategies as st
    segs = TABLES[name]
    top = float(segs[-1][1])

    @settings(max_examples=15, deadline=None)
    @given(st.lists(st.floats(min_value=0, max_value=top, allow_nan=False), min_size=2,
                    max_size=20))
    def check(xs):
        xs = sorted(set(round(x, 2) for x in xs if round(x, 2) <= top))
        got = _index(spark, xs, segs)
        seq = [got[x] for x in xs]
        assert seq == sorted(seq)
        assert all(got[x] == _reference_index(x, segs) for x in xs)
    check()


def test_exact_mean_half_up(spark):
    from airindex.functions.exact import mean_half_up
    # 69.245 is a half-way mean: a double sum may land either side; exact gives .25
    df = spark.createDataFrame([(1, 69.24), (1, 69.25), (2, -0.005), (2, None), (3, None)],
                               "k int, x double")
    got = {r.k: r.m for r in df.groupBy("k").agg(mean_half_up("x", 2).alias("m")).collect()}
    assert got == {1: 69.25, 2: -0.01, 3: None}
    assert df.select(F.lit(1)).count() == 5


# Literal expectations, not taken from the tables under test: (concentration, index).
EXPECTED = {
    "pm25": [(0, 0), (25, 50), (25.5, 51), (50, 100), (51, 102), (80, 150), (81, 151), (150, 200), (151, 201),
             (250, 300), (251, 301), (500, 500), (500.5, 0)],
    "pm10": [(0, 0), (50, 50), (52, 51), (150, 100), (152, 101), (250, 150), (252, 151), (350, 200), (352, 203),
             (420, 300), (421, 303), (500, 500), (501, 0)],
    "co": [(0, 0), (10000, 50), (10500, 52), (30000, 100), (31000, 104), (45000, 150), (46000, 154), (60000, 200),
           (61000, 204), (90000, 300), (91000, 307), (120000, 500), (120001, 0)],
    "no2": [(0, 0), (100, 50), (102, 51), (200, 100), (210, 101), (700, 150), (710, 151), (1200, 200), (1210, 201),
            (2350, 300), (2360, 302), (3850, 500), (3851, 0)],
    "so2": [(0, 0), (125, 50), (126, 51), (350, 100), (351, 101), (550, 150), (551, 151), (800, 200), (810, 202),
            (1600, 300), (1610, 302), (2630, 500), (2631, 0)],
    "o3_1h": [(0, 0), (160, 50), (161, 52), (200, 100), (201, 101), (300, 150), (301, 151), (400, 200), (401, 201),
              (800, 300), (801, 301), (1200, 500), (1201, 0)],
    "o3_8h": [(0, 0), (160, 50), (161, 52), (200, 100), (201, 101), (300, 150), (301, 151), (400, 200), (401, 0)],
}


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_literal_values_of_each_table(spark, name):
    got = _index(spark, [float(x) for x, _ in EXPECTED[name]], TABLES[name])
    assert {x: got[float(x)] for x, _ in EXPECTED[name]} == dict(EXPECTED[name])
