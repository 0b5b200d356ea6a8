"""Exact means at and beyond what a long sum holds."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from airindex.functions.exact import exact_window_mean, mean_half_up, sum_exact


def _mean(spark, values, digits=2):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    return df.agg(mean_half_up("v", digits).alias("m")).first().m


def test_large_hourly_values(spark):
    assert _mean(spark, [1e12] * 24) == 1e12
    assert _mean(spark, [-1e12] * 23 + [1e12]) == round(-22e12 / 24, 2)
    assert _mean(spark, [2e9] * 24 + [None]) == 2e9


def test_many_rows_as_one_heavy_sum(spark):
    # 1e9 location-days at index 500 as 1e5 rows of 5e6: the same sum of units.
    df = spark.range(100_000).select(F.lit(5e6).alias("v"))
    row = df.agg(mean_half_up("v", 2).alias("m"), sum_exact("v").alias("s")).first()
    assert row.m == 5e6 and row.s == 5e11
    heavy = spark.range(2_000).select(F.lit(9e15).alias("v"))
    assert heavy.agg(mean_half_up("v", 2).alias("m")).first().m == 9e15


def test_half_away_from_zero(spark):
    assert _mean(spark, [69.24, 69.25]) == 69.25      # 69.245
    assert _mean(spark, [-69.24, -69.25]) == -69.25
    assert _mean(spark, [None, None]) is None and _mean(spark, []) is None
    assert _mean(spark, [0.1, 0.2, 0.4], 0) == 0.0


def test_window_mean_of_large_values(spark):
    df = spark.createDataFrame([(i, 3e12) for i in range(9)], "i int, v double")
    w = Window.orderBy("i").rowsBetween(-7, 0)
    assert {r.m for r in df.select(exact_window_mean("v", w).alias("m")).collect()} == {3e12}
