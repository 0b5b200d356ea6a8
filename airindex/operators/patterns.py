"""Analytical views: pollutant correlations, temporal patterns and category shares."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airindex.functions.dates import iso_day_of_week
from airindex.functions.exact import mean_half_up
from airindex.operators.numbering import running_totals
from airindex.operators.rolling import BUCKET, with_month_halo
from airindex.schemas import POLLUTANTS, READING_KEYS

CORR_DIGITS = 6


def pollutant_correlation(readings: DataFrame, cols: Sequence[str] = POLLUTANTS,
                          by: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation of every pollutant pair, long form (a, b, corr, n).

    All pairs are computed in one aggregate pass (partial + final), then unpivoted.
    """
    pairs = list(combinations(cols, 2))
    aggs = []
    for i, (a, b) in enumerate(pairs):
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        aggs += [F.corr(a, b).alias(f"c{i}"), F.count_if(both).alias(f"n{i}")]
    wide = readings.groupBy(*by).agg(*aggs) if by else readings.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(a).alias("pollutant_a"), F.lit(b).alias("pollutant_b"),
                 F.round(F.col(f"c{i}"), CORR_DIGITS).alias("corr"), F.col(f"n{i}").alias("n"))
        for i, (a, b) in enumerate(pairs)]))
    return wide.select(*by, rows.alias("p")).select(*by, "p.*")


def average_ranks(df: DataFrame, cols: Sequence[str] = POLLUTANTS, row: Sequence[str] = READING_KEYS) -> DataFrame:
    """row, and for every column its rank among all non-NULL values of the column (ties: the mean of their
    places; NULL stays NULL). ``row`` identifies a row.

    Ranks are made from the distinct values and their counts: a running total over range-partitioned
    values, so no task sorts a column.
    """
    long = (df.select(*row, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(list(row), list(cols), "_column", "_value")
            .filter("_value IS NOT NULL"))
    values = long.groupBy("_column", "_value").agg(F.count(F.lit(1)).alias("_count"))
    placed = running_totals(values, ["_column"], ["_value"], "_count")
    ranks = placed.select("_column", "_value", (F.col("_before") + (F.col("_count") + 1) / 2).alias("_rank"))
    return long.join(ranks, ["_column", "_value"]).groupBy(*row).agg(
        *[F.max(F.when(F.col("_column") == c, F.col("_rank"))).alias(c) for c in cols])


def rank_correlation(readings: DataFrame, cols: Sequence[str] = POLLUTANTS, row: Sequence[str] = READING_KEYS) -> DataFrame:
    """Spearman's correlation of every pollutant pair: Pearson's over the average ranks (a, b, corr, n)."""
    return pollutant_correlation(average_ranks(readings, cols, row), cols)


def lagged_correlation(readings: DataFrame, lead: str, follow: str, hours: int = 24, ts: str = "measured_at",
                       partition: Sequence[str] = ("location_id",), day: str = "measure_date") -> DataFrame:
    """Correlation of ``follow`` with ``lead`` as it was 0 to ``hours`` hours before, at one location:
    (lag_hours, corr, n).

    Values are aligned by time, not by row (an absent hour has no value): a range frame of one instant per lag,
    all over one sort of a location-month and the hours before it.
    """
    if hours >= 28 * 24:
        raise ValueError("lagged_correlation supports lags shorter than a month")
    epoch = F.unix_timestamp(F.col(ts))
    next_month = F.unix_timestamp(F.add_months(F.trunc(F.col(day), "month"), 1).cast("timestamp"))
    rows = with_month_halo(readings.select(*partition, ts, day, F.col(lead).alias("_lead"), F.col(follow).alias("_follow"), epoch.alias("_epoch")),
                           day, F.col("_epoch") >= next_month - hours * 3600)
    w = Window.partitionBy(*partition, BUCKET).orderBy("_epoch")
    lagged = rows.withColumns({f"_l{k}": F.max("_lead").over(w.rangeBetween(-3600 * k, -3600 * k)) for k in range(hours + 1)})
    own = lagged.filter(F.trunc(F.col(day), "month") == F.col(BUCKET))
    wide = own.agg(*[x for k in range(hours + 1) for x in (
        F.corr(f"_l{k}", "_follow").alias(f"c{k}"), F.count_if(F.col(f"_l{k}").isNotNull() & F.col("_follow").isNotNull()).alias(f"n{k}"))])
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("lag_hours"), F.round(F.col(f"c{k}"), CORR_DIGITS).alias("corr"), F.col(f"n{k}").alias("n"))
                                for k in range(hours + 1)]))
    return wide.select(pairs.alias("p")).select("p.*")


def pattern_by(df: DataFrame, part: str, value: str, ts: str = "measured_at",
               by: Sequence[str] = ()) -> DataFrame:
    """Mean / max / count of ``value`` per ``hour`` | ``weekday`` | ``month`` of ``ts``."""
    parts = {"hour": F.hour(F.col(ts)), "weekday": iso_day_of_week(F.col(ts)),
             "month": F.month(F.col(ts))}
    if part not in parts:
        raise ValueError(f"part must be one of {sorted(parts)}")
    return (df.groupBy(*by, parts[part].alias(part))
            .agg(mean_half_up(value, 2).alias(f"avg_{value}"),
                 F.max(value).alias(f"max_{value}"),
                 F.count(value).alias("n")))


def rollup_year_month(fact: DataFrame, value: str = "vn_aqi") -> DataFrame:
    """Mean and count by (year, month) with subtotals per year and a grand total."""
    d = F.col("measure_date")
    return (fact.rollup(F.year(d).alias("year"), F.month(d).alias("month"))
            .agg(mean_half_up(value, 2).alias(f"avg_{value}"),
                 F.count(F.lit(1)).alias("days"),
                 F.grouping_id().alias("level")))


def share_by(df: DataFrame, category: str, digits: int = 4) -> DataFrame:
    """Count and share of rows per category (NULL is its own category).

    The total is a scalar subquery over the counts (partial + final sums), so any number
    of categories stays distributed.
    """
    counts = df.groupBy(category).agg(F.count(F.lit(1)).alias("days"))
    total = counts.agg(F.sum("days")).scalar()
    return counts.withColumn("share", F.round(F.col("days") / total, digits))
