"""The stateful row window: its step against plain Python, and across restarts of a stream."""

import datetime as dt
import os
import random

import numpy as np
from pyspark.sql import functions as F

from airindex.plans import queries_stream
from airindex.streaming.landing import sliding_mean
from airindex.streaming.rolling import DAY_US, KEYS_PER_BUCKET, buckets_for, packed, passed, rolling_rows_stream, run_counting_late, unpacked

HOUR = 3_600_000_000
SCHEMA = "location_id int, measured_at timestamp, o3 double"


def brute(rows, n=8):
    """(time, value, mean, count) of rows sorted by time, over the last n rows of the day and the day before."""
    rows = sorted(rows)
    out = []
    for i, (at, v) in enumerate(rows):
        frame = [x for t, x in rows[max(i - n + 1, 0): i + 1] if t >= (at // DAY_US - 1) * DAY_US and x is not None]
        out.append((at, v, sum(round(x * 1e6) for x in frame) / (len(frame) * 1e6) if frame else None, len(frame)))
    return out


def test_step_in_any_portions():
    rng = random.Random(1)
    rows = [(HOUR * h, None if rng.random() < 0.2 else round(rng.random() * 90, 2)) for h in range(0, 900) if rng.random() < 0.4]
    state = (np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64), np.empty(0))
    got, until = [], 0
    todo = list(rows)
    while todo or len(state[0]):
        take, todo = todo[:37], todo[37:]
        rng.shuffle(take)
        state = (np.append(state[0], [t for t, _ in take]).astype(np.int64), np.append(state[1], [np.nan if v is None else v for _, v in take]), *state[2:])
        until = take and min(t for t, _ in todo[:1] or [(1 << 60, 0)]) - 1 or 1 << 60
        (at, value, mean, count), state = passed(*state, until, 8)
        got += [(int(t), None if np.isnan(v) else float(v), m, int(c)) for t, v, m, c in zip(at, value, mean, count, strict=True)]
        assert len(state[2]) <= 7
    assert got == brute(rows)


def at(hour):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=hour)


def test_out_of_order_restarts_duplicates_and_late_rows(spark, tmp_dir):
    source, table, checkpoint = (os.path.join(tmp_dir, x) for x in ("in", "out", "ckpt"))
    os.makedirs(source)
    stream = rolling_rows_stream(spark.readStream.schema(SCHEMA).parquet(source), "5 hours")

    def land(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        return run_counting_late(stream, table, checkpoint)

    first = [(k, at(h), float(h + k)) for h in (3, 1, 0, 6, 4, 9) for k in (0, 1)]
    second = [(0, at(5), 5.5), (0, at(8), None), (1, at(30), 30.0), (0, at(9), 99.0)]  # 9: again, still pending
    late = [(0, at(2), 2.0), (1, at(7), 7.0), (0, at(26), 26.0)]
    assert land(first).late == 0 and land(second).late == 0
    ran = land(late)
    assert (ran.rows, ran.late) == (3, 2)
    assert land([(0, at(80), 1.0)]).late == 0
    kept = {(k, t): v for k, t, v in [*first, *second, late[2]]}
    want = []
    for k in (0, 1):
        rows = [(int((t - dt.datetime(1970, 1, 1)).total_seconds() * 1e6), v) for (j, t), v in kept.items() if j == k]
        want += [(k, dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=t), v, m, n) for t, v, m, n in brute(rows)]
    out = spark.read.parquet(table).select("location_id", "measured_at", "o3", "rolling_o3", "count_o3").collect()
    assert sorted(map(str, map(tuple, out))) == sorted(map(str, want))


def test_closed_windows_only(spark, tmp_dir):
    source, table = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    rows = [(0, at(h), float(h)) for h in range(30)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(source)
    stream = sliding_mean(spark.readStream.schema(SCHEMA).parquet(source), watermark="2 hours 30 minutes")
    run_counting_late(stream, table, os.path.join(tmp_dir, "ckpt"))
    batch = sliding_mean(spark.createDataFrame(rows, SCHEMA)).filter(F.col("window_end") <= F.lit(at(26.5)))
    assert sorted(map(tuple, spark.read.parquet(table).collect())) == sorted(map(tuple, batch.collect()))


def test_keys_share_state_rows(spark, tmp_dir):
    source, table, checkpoint = (os.path.join(tmp_dir, x) for x in ("in", "out", "ckpt"))
    keys = [None, *(f"place {k}" for k in range(2 * KEYS_PER_BUCKET))]
    assert [buckets_for(n) for n in (0, 1, KEYS_PER_BUCKET, KEYS_PER_BUCKET + 1)] == [1, 1, 1, 2]
    schema, rng, rows = "place string, measured_at timestamp, o3 double", random.Random(2), []
    os.makedirs(source)
    stream = rolling_rows_stream(spark.readStream.schema(schema).parquet(source), "5 hours", key="place", buckets=buckets_for(len(keys) - 1))
    for hours in ((0, 1, 2, 5, 30), (3, 29, 31, 60), (59, 200)):
        part = [(k, at(h), None if rng.random() < 0.2 else round(rng.random() * 90, 2)) for h in hours for k in keys if h == 200 or rng.random() < 0.7]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        run_counting_late(stream, table, checkpoint)
        mark = max(h for h in hours) - 5
        rows += part
    want = []
    # Rows behind the watermark of the runs before are late: hour 3 after 25, none else.
    rows = [(k, t, v) for k, t, v in rows if t != at(3)]
    for k in keys:
        mine = [(int((t - dt.datetime(1970, 1, 1)).total_seconds() * 1e6), v) for j, t, v in rows if j == k]
        want += [(k, dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=t), v, m, n) for t, v, m, n in brute(mine)
                 if t <= int((at(mark) - dt.datetime(1970, 1, 1)).total_seconds() * 1e6)]
    got = spark.read.parquet(table).select("place", "measured_at", "o3", "rolling_o3", "count_o3").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    # Two buckets and that of the rows without a key, however many keys there are.
    state = spark.read.format("statestore").load(checkpoint)
    assert state.count() <= 3 and sum(len(r["value"]["groupState"]["keys"]) for r in state.collect()) == len(keys)


def test_state_row_round_trip():
    groups = {"a": (np.array([3, 5]), np.array([1.5, np.nan]), np.array([1]), np.array([0.5])),
              None: (np.empty(0, np.int64), np.empty(0), np.array([7, 8]), np.array([2.0, 4.0]))}
    back = unpacked(packed(groups))
    assert list(back) == list(groups)
    for key, arrays in groups.items():
        for one, other in zip(arrays, back[key], strict=True):
            np.testing.assert_array_equal(one, other)


def test_arrivals_are_made_from_the_events_once(spark, tmp_dir, monkeypatch):
    rows = [(i, at(7 * i), i % 60, ("error", "view")[i % 2], float(i % 50)) for i in range(100)]
    spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double").selectExpr(
        "*", "'{}' AS props").write.parquet(f"{tmp_dir}/events.parquet")
    spark.createDataFrame([(k, f"N{k}", 0) for k in range(25)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{tmp_dir}/nation.parquet")
    landed, append_raw = [], queries_stream.append_raw

    def spied(payload, root):
        landed.append((payload.inputFiles(), payload.selectExpr("sum(size(list))").first()[0] or 0))
        append_raw(payload, root)

    monkeypatch.setattr(queries_stream, "append_raw", spied)
    n = queries_stream.q_stream_late_rows(spark, tmp_dir).first()
    assert sum(k for _, k in landed) == n["in_time"] + n["late"] == queries_stream.readings(spark, tmp_dir).count()
    assert not [f for files, _ in landed for f in files if "events.parquet" in f]
