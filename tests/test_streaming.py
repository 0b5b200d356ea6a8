"""Streaming landing -> upsert, replay idempotence, sliding windows; empty inputs; dates."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from airindex.plans.daily import daily_air_index, two_day_buffer
from airindex.schemas import READING
from airindex.streaming.landing import (landing_stream, run_available_now, sliding_mean,
                                        upsert_sink)

LOCS = "location_id int, city_name string, lon double, lat double"


def _land(root, city, day, lon, lat, hours, o3=10.0):
    path = os.path.join(root, city, f"{day:%Y}", f"{day:%m}", f"{day:%d}.json")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    start = int(dt.datetime(day.year, day.month, day.day, tzinfo=dt.timezone.utc).timestamp())
    items = [{"dt": start + 3600 * h, "main": {"aqi": 2},
              "components": {"o3": o3 + h, "pm2_5": 12.5}} for h in hours]
    with open(path, "w") as fh:
        json.dump({"coord": {"lon": lon, "lat": lat}, "list": items}, fh, indent=4)


def test_stream_upsert_and_replay(spark, tmp_dir):
    locs = spark.createDataFrame([(0, "A", 100.0, 10.0), (1, "B", 101.0, 11.0)], LOCS)
    landing, table = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "silver")
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    _land(landing, "a", d1, 100.0, 10.0, range(24))
    _land(landing, "b", d1, 101.0, 11.0, range(12))
    run_available_now(landing_stream(spark, landing, locs, max_files_per_trigger=1),
                      upsert_sink(table), os.path.join(tmp_dir, "ckpt"))
    t = spark.read.schema(READING).parquet(table)
    assert t.count() == 36
    # A corrected file for day 1 of location b and a new day arrive later.
    _land(landing, "b2", d1, 101.0, 11.0, range(24), o3=50.0)
    _land(landing, "a", d2, 100.0, 10.0, range(3))
    run_available_now(landing_stream(spark, landing, locs), upsert_sink(table),
                      os.path.join(tmp_dir, "ckpt"))
    t = spark.read.schema(READING).parquet(table)
    assert t.count() == 24 + 24 + 3
    assert t.filter((F.col("location_id") == 1) & (F.col("o3") < 50)).count() == 0
    # A fresh checkpoint replays every file: the merge leaves the table unchanged.
    before = sorted(tuple(r) for r in t.collect())
    run_available_now(landing_stream(spark, landing, locs), upsert_sink(table),
                      os.path.join(tmp_dir, "ckpt-replay"))
    after = sorted(tuple(r) for r in spark.read.schema(READING).parquet(table).collect())
    assert after == before


def test_sliding_mean_stream_matches_batch(spark, tmp_dir):
    rows = [(0, dt.datetime(2024, 1, 1, h), float(h)) for h in range(10)]
    df = spark.createDataFrame(rows, "location_id int, measured_at timestamp, o3 double")
    batch = sorted(tuple(r) for r in sliding_mean(df).collect())
    src = os.path.join(tmp_dir, "src")
    df.write.parquet(src)
    stream = spark.readStream.schema(df.schema).parquet(src)
    q = (sliding_mean(stream, watermark="1 day").writeStream.outputMode("complete")
         .format("memory").queryName("sliding_test").start())
    q.processAllAvailable()
    q.stop()
    streamed = sorted(tuple(r) for r in spark.table("sliding_test").collect())
    assert streamed == batch
    first = [r for r in batch if r[1] == dt.datetime(2024, 1, 1, 2)][0]
    assert first[3] == round((2 + 3 + 4 + 5 + 6 + 7 + 8 + 9) / 8, 6) and first[4] == 8


def test_empty_inputs_flow_through(spark):
    empty = spark.createDataFrame([], READING)
    assert daily_air_index(empty).count() == 0
    assert two_day_buffer(empty).count() == 0


def test_process_date_validation():
    from airindex.plans.daily import _as_date
    assert _as_date("2024-01-05") == dt.date(2024, 1, 5)
    with pytest.raises(ValueError):
        _as_date("2024/01/05")
    with pytest.raises(ValueError):
        _as_date("2024-13-01")


def test_continuous_trigger(spark, tmp_dir):
    from airindex.streaming.landing import start_continuous
    locs = spark.createDataFrame([(0, "A", 100.0, 10.0)], LOCS)
    landing, table = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "silver")
    _land(landing, "a", dt.date(2024, 2, 1), 100.0, 10.0, range(5))
    q = start_continuous(landing_stream(spark, landing, locs), upsert_sink(table),
                         os.path.join(tmp_dir, "ckpt"), every="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.schema(READING).parquet(table).count() == 5
