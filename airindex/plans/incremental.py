"""Late data: land updated readings, then recompute only the daily facts they affect.

The ozone window reaches back into the previous day, so a reading on day D
changes the facts of D and D+1 for its location. ``refresh_daily_fact``:

1. upserts the updates into the day-partitioned reading table;
2. derives the affected (location, day) pairs;
3. reads only the affected days and the day before each (partition pruning by
   date literals; the distinct days are calendar-bounded), recomputes the fact
   and keeps the affected pairs;
4. upserts those rows into the day-partitioned fact table.

The result equals recomputing the fact from the whole reading table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airindex.operators.upsert import affected_dates, upsert_partitioned
from airindex.plans.daily import daily_air_index
from airindex.schemas import (FACT_KEYS, FACT_UPDATE_COLS, READING, READING_KEYS,
                              READING_UPDATE_COLS)
from airindex.session import remove_path, scratch_path


def refresh_daily_fact(spark: SparkSession, readings_path: str, fact_path: str,
                       updates: DataFrame, reach_days: int = 1) -> DataFrame:
    """Apply late ``updates`` to the reading table and refresh the affected facts.

    Returns the affected (location_id, measure_date) pairs.
    """
    columns = [f.name for f in READING.fields]
    # The updates are read twice (merge, affected days): write them once.
    staged = scratch_path(spark, "late")
    updates.select(*columns).write.parquet(staged)
    late = spark.read.schema(READING).parquet(staged)
    upsert_partitioned(spark, readings_path, late, READING_KEYS, "measure_date",
                       READING_UPDATE_COLS, schema=READING)
    affected = affected_dates(late.filter(F.col("location_id").isNotNull()),
                              reach_days).checkpoint(eager=True)
    remove_path(spark, staged)
    days = sorted(r[0] for r in affected.select("measure_date").distinct().collect())
    if not days:
        return affected
    needed = sorted(set(days) | {d - dt.timedelta(days=1) for d in days})
    src = (spark.read.schema(READING).parquet(readings_path)
           .filter(F.col("measure_date").isin(needed)))
    # Only the affected location-days and the day before each (the window's halo) are computed.
    pairs = affected.select("location_id", F.explode(F.array(
        "measure_date", F.date_sub("measure_date", 1))).alias("measure_date")).distinct()
    src = src.join(pairs, ["location_id", "measure_date"], "left_semi")
    fresh = daily_air_index(src).join(affected, ["location_id", "measure_date"], "left_semi")
    upsert_partitioned(spark, fact_path, fresh, FACT_KEYS, "measure_date", FACT_UPDATE_COLS)
    return affected


def load_daily_fact(spark: SparkSession, readings_path: str, fact_path: str,
                    readings: DataFrame) -> None:
    """Initial load: readings into their table, the fact computed from them into its table."""
    columns = [f.name for f in READING.fields]
    upsert_partitioned(spark, readings_path, readings.select(*columns), READING_KEYS,
                       "measure_date", READING_UPDATE_COLS, schema=READING)
    table = spark.read.schema(READING).parquet(readings_path)
    upsert_partitioned(spark, fact_path, daily_air_index(table), FACT_KEYS, "measure_date",
                       FACT_UPDATE_COLS)
