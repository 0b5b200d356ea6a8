"""Tables that stay put, numbered rows, sketches and correlations against plain Python."""

import datetime as dt
import os
import random
import re
import uuid

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from airindex.operators.numbering import number_rows, rolling_rows_dense, running_totals
from airindex.operators.patterns import average_ranks, lagged_correlation, rank_correlation
from airindex.operators.sketches import day_sketches, merged, quantile, rank_of, store_sketches
from airindex.operators.upsert import merge_frames, upsert_partitioned
from airindex.sinks.bucketed import merge_bucketed, save_bucketed, table_stays

LOG = "location_id int, measured_at timestamp, measure_date date, x double"


def moment(hour):
    return dt.datetime(2024, 1, 30) + dt.timedelta(hours=hour)


def rows(locations, hours, add=0.0):
    return [(k, moment(h), moment(h).date(), h + k / 10 + add) for k in locations for h in hours]


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_merge_moves_only_the_updates(spark, tmp_dir):
    name = f"t{uuid.uuid4().hex}"
    save_bucketed(spark.createDataFrame(rows(range(9), range(40)), LOG), name, 4, path=os.path.join(tmp_dir, "v1"))
    updates = spark.createDataFrame(rows((2, 50), range(30, 60), 100.0), LOG)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with table_stays(spark, 4):
            plan = executed(merge_frames(spark.table(name), updates, ["location_id", "measured_at"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Above the table's scan there is no exchange, up to the join; the updates are moved twice (reduced, then to the buckets).
    lines = plan.split("== Initial Plan ==")[0].splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan parquet" in line)
    above, level = [], len(re.match(r"[ :+*()\d-]*", lines[scan]).group())
    for line in reversed(lines[:scan]):
        indent = len(re.match(r"[ :+*()\d-]*", line).group())
        if indent < level:
            above.append(line)
            level = indent
    assert any("FullOuter" in line for line in above) and not any("Exchange" in line for line in above)
    assert len([line for line in lines if "Exchange hashpartitioning" in line]) == 2
    merge_bucketed(spark, name, updates, ["location_id", "measured_at"], buckets=4, path=os.path.join(tmp_dir, "v2"))
    got = {(r[0], r[1]): r[3] for r in spark.table(name).collect()}
    want = {(k, t): x for k, t, _, x in rows(range(9), range(40))} | {(k, t): x for k, t, _, x in rows((2, 50), range(30, 60), 100.0)}
    assert got == want
    merge_bucketed(spark, name, spark.createDataFrame(rows((7,), [1], 5.0), LOG), ["location_id", "measured_at"], buckets=4)
    assert spark.table(name).count() == len(want)
    window = spark.table(name).withColumn("n", F.count("x").over(Window.partitionBy("location_id").orderBy("measured_at")))
    assert "Exchange" not in executed(window)
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def _files(root):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_late_row_rewrites_its_part_only(spark, tmp_dir):
    table = os.path.join(tmp_dir, "t")
    keys = ["location_id", "measured_at"]
    upsert_partitioned(spark, table, spark.createDataFrame(rows(range(40), range(48)), LOG), keys, "measure_date", parts=8)
    before = _files(table)
    late = spark.createDataFrame(rows((3,), [5], 1000.0) + [(None, moment(1), moment(1).date(), 1.0)], LOG)
    rejects = upsert_partitioned(spark, table, late, keys, "measure_date", parts=8)
    assert rejects.columns == late.columns and rejects.count() == 1
    after = _files(table)
    gone = {f for f in before if f not in after}
    assert len({os.path.dirname(f) for f in gone}) == 1 and len(after) >= 16
    got = spark.read.parquet(table)
    assert got.count() == 40 * 48 and got.filter("x > 900").count() == 1
    with pytest.raises(ValueError, match="not partitioned"):
        plain = os.path.join(tmp_dir, "plain")
        upsert_partitioned(spark, plain, spark.createDataFrame(rows((1,), [1]), LOG), keys, "measure_date")
        upsert_partitioned(spark, plain, spark.createDataFrame(rows((1,), [1]), LOG), keys, "measure_date", parts=8)


def test_places_and_totals(spark):
    rng = random.Random(1)
    data = [(rng.choice(["a", "a", "a", "b", None]), i, rng.randrange(9)) for i in range(700)]
    df = spark.createDataFrame(data, "k string, o long, w long").repartition(9)
    place, total, want = {}, {}, {}
    for k, o, w in sorted(data, key=lambda r: r[1]):
        want[o] = (place.get(k, 0), total.get(k, 0))
        place[k], total[k] = place.get(k, 0) + 1, total.get(k, 0) + w
    assert {r["o"]: r["p"] for r in number_rows(df, ["k"], ["o"], "p").collect()} == {o: p for o, (p, _) in want.items()}
    some = running_totals(df.filter("k IS NOT NULL"), ["k"], ["o"], "w", "t")
    assert {r["o"]: r["t"] for r in some.collect()} == {o: want[o][1] for k, o, _ in data if k is not None}
    assert number_rows(df.limit(0), ["k"], ["o"]).count() == 0


@pytest.mark.parametrize("segment", [8, 13, 5000])
def test_dense_rolling_over_segments(spark, segment):
    """One group with nearly all rows: frames reach back over every cut."""
    rng = random.Random(2)
    data = [("hot", i, None if rng.random() < 0.2 else round(rng.random() * 99, 2)) for i in range(600)] + [("cold", 1, 5.0), ("cold", 2, None)]
    df = spark.createDataFrame(data, "k string, o long, v double")
    got = {(r["k"], r["o"]): (r["rolling_v"], r["count_v"]) for r in rolling_rows_dense(df, "v", ["k"], ["o"], 8, segment).collect()}
    for k, o, _ in data:
        frame = [v for j, i, v in data if j == k and o - 8 < i <= o and v is not None]
        mean = sum(round(v * 1e6) for v in frame) / (len(frame) * 1e6) if frame else None
        assert got[k, o] == (mean, len(frame))
    assert len(got) == len(data)
    with pytest.raises(ValueError):
        rolling_rows_dense(df, "v", ["k"], ["o"], 8, 4)


def test_sketches_merge_to_any_range(spark, tmp_dir):
    rng = np.random.default_rng(3)
    data = [(k, moment(h).date(), float(rng.gamma(2.0, 10.0)) if i % 9 else None) for k in (0, 1) for h in range(0, 24 * 40, 24) for i in range(300)]
    df = spark.createDataFrame(data, "location_id int, measure_date date, v double")
    path = os.path.join(tmp_dir, "sketches")
    store_sketches(day_sketches(df, "v"), path)
    store_sketches(day_sketches(df.filter(F.col("measure_date") == moment(0).date()), "v"), path)  # a day again: replaced
    stored = spark.read.parquet(path)
    assert stored.count() == 80
    late = moment(24 * 10).date()
    for part, keep in ((stored, lambda d: True), (stored.filter(F.col("measure_date") >= F.lit(late)), lambda d: d >= late)):
        for r in merged(part, ("location_id",)).select("location_id", "n", *[quantile("sketch", q).alias(f"q{i}") for i, q in enumerate((0.1, 0.5, 0.99))],
                                                       rank_of("sketch", F.lit(20.0)).alias("rank")).collect():
            values = np.array([v for k, d, v in data if k == r["location_id"] and v is not None and keep(d)])
            assert r["n"] == len(values) and r["rank"] == pytest.approx((values <= 20).mean(), abs=0.03)
            for i, q in enumerate((0.1, 0.5, 0.99)):
                assert (values <= r[f"q{i}"]).mean() == pytest.approx(q, abs=0.03)


def test_rank_and_lagged_correlation(spark):
    rng = random.Random(5)
    data = []
    for k in (0, 1):
        for h in range(24 * 80):
            if rng.random() < 0.8:
                data.append((k, moment(h), moment(h).date(), rng.randrange(5) if rng.random() < 0.9 else None, float(rng.randrange(40)) / 4))
    df = spark.createDataFrame(data, "location_id int, measured_at timestamp, measure_date date, a int, b double")
    frame = pd.DataFrame(data, columns=["k", "t", "d", "a", "b"])
    ranks = frame[["a", "b"]].rank()
    got = average_ranks(df, ["a", "b"]).toPandas().set_index(["location_id", "measured_at"]).sort_index()
    want = ranks.set_index(pd.MultiIndex.from_frame(frame[["k", "t"]])).sort_index()
    np.testing.assert_allclose(got["b"], want["b"])
    np.testing.assert_allclose(got["a"].to_numpy(float), want["a"].to_numpy(float))
    out = rank_correlation(df, ["a", "b"]).collect()[0]
    assert out["corr"] == pytest.approx(ranks["a"].corr(ranks["b"]), abs=1e-6) and out["n"] == frame["a"].notna().sum()
    lags = {r["lag_hours"]: r for r in lagged_correlation(df, "b", "a", 30).collect()}
    before = {(k, t): b for k, t, _, _, b in data}
    for lag in (0, 1, 24, 30):
        pairs = [(a, before[k, t - dt.timedelta(hours=lag)]) for k, t, _, a, _ in data if a is not None and (k, t - dt.timedelta(hours=lag)) in before]
        assert lags[lag]["n"] == len(pairs)
        assert lags[lag]["corr"] == pytest.approx(np.corrcoef(np.array(pairs, float).T)[0, 1], abs=1e-6)
