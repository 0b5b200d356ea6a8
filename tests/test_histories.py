"""Checked payloads, the ledger, histories, gap ranges and SQL functions against plain Python."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from airindex.functions import index as index_columns
from airindex.functions import labels
from airindex.operators.conform import flatten_measurements
from airindex.operators.validity import as_of_join, gap_ranges, state_changes, validity
from airindex.plans.sql_functions import register_functions
from airindex.schemas import RAW
from airindex.sources.checked import REJECTED, read_checked, read_good, split_checked
from airindex.sources.ledger import landed_files, process_new, read_ledger, unprocessed

GOOD = {"coord": {"lon": 1.0, "lat": 2.0}, "list": [{"dt": 1704412800, "main": {"aqi": 2}, "components": {"o3": 1.5}}]}


def _land(root, name, text):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text if isinstance(text, str) else json.dumps(text))
    return path


@pytest.mark.parametrize("multi_line", [False, True])
def test_damaged_documents_go_to_quarantine(spark, tmp_dir, multi_line):
    root, table = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "quarantine")
    text = json.dumps(GOOD, indent=2) if multi_line else json.dumps(GOOD)
    cases = {"good": text, "cut": text[:-7], "words": "not json", "bare": {"list": GOOD["list"]}, "half": {"coord": {"lon": 1.0}, "list": []},
             "null": {"coord": GOOD["coord"], "list": None}, "empty": {"coord": GOOD["coord"], "list": []},
             "typed": json.dumps(GOOD).replace("1704412800", '"soon"')}
    for name, doc in cases.items():
        _land(root, f"a/{name}.json", doc)
    good = read_good(spark, root, table, multi_line)
    assert good.columns == ["coord", "list"] and good.count() == 2
    assert flatten_measurements(good).count() == 1
    read_good(spark, root, table, multi_line)
    got = {os.path.basename(r["path"])[:-5]: r for r in spark.read.schema(REJECTED).parquet(table).collect()}
    assert {k: r["reason"] for k, r in got.items()} == {"cut": "malformed", "words": "malformed", "typed": "malformed", "bare": "no_coordinates",
                                                        "half": "no_coordinates", "null": "no_measurements"}
    assert "not json" in got["words"]["payload"] and got["cut"]["payload"] and got["cut"]["modified"]
    # Without the check such a document is a row of NULLs that explodes to nothing.
    assert read_checked(spark, root, multi_line).filter("reason IS NULL").count() == 2


def test_same_bad_line_twice_and_a_line_that_comes_later(spark, tmp_dir):
    root, table = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "quarantine")
    _land(root, "one.json", "bad\nbad\n" + json.dumps(GOOD) + "\n")
    read_good(spark, root, table)
    assert spark.read.schema(REJECTED).parquet(table).count() == 2
    _land(root, "two.json", "worse\n")
    good, rejects = split_checked(read_checked(spark, root))
    assert good.count() == 1 and rejects.count() == 3
    read_good(spark, root, table)
    assert spark.read.schema(REJECTED).parquet(table).count() == 3


def test_ledger_reads_new_and_changed_files_only(spark, tmp_dir):
    root, ledger = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "ledger")
    assert process_new(spark, root, ledger, lambda p: None).count() == 0
    first, second = _land(root, "a/1.json", GOOD), _land(root, "b/2.json", GOOD)
    _land(root, "b/notes.txt", "no payload")
    read = []

    def process(payload):
        read.append(sorted(os.path.basename(f) for f in payload.inputFiles()))
        assert payload.schema == RAW and payload.count() == len(read[-1])

    assert process_new(spark, root, ledger, process).count() == 2
    _land(root, "a/3.json", GOOD)
    os.utime(second, (2_000_000_000, 2_000_000_000))
    with pytest.raises(RuntimeError):
        process_new(spark, root, ledger, lambda p: (_ for _ in ()).throw(RuntimeError("failed")))
    assert process_new(spark, root, ledger, process).count() == 2
    assert process_new(spark, root, ledger, process).count() == 0
    assert read == [["1.json", "2.json"], ["2.json", "3.json"]]
    assert unprocessed(landed_files(spark, root), read_ledger(spark, ledger)).isEmpty()
    assert read_ledger(spark, ledger).count() == 4 and os.path.exists(first)


def test_many_new_files_are_several_reads(spark, tmp_dir, monkeypatch):
    from airindex.sources import ledger as module
    monkeypatch.setattr(module, "FILES_PER_READ", 3)
    root = os.path.join(tmp_dir, "landing")
    for i in range(7):
        _land(root, f"{i}.json", GOOD)
    rows = []
    process_new(spark, root, os.path.join(tmp_dir, "ledger"), lambda p: rows.append(p.count()))
    assert sorted(rows) == [1, 3, 3]


def moment(hours):
    return dt.datetime(2024, 1, 30) + dt.timedelta(hours=hours)


def random_log(seed, n=120):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "b", "c"]), moment(rng.randrange(0, 3000)), rng.randrange(3)) for _ in range(n)]
    return rows + [(None, moment(5), 1), ("a", None, 2), ("d", moment(7), 0), ("a", rows[0][1], 2), (rows[0][0], rows[0][1], 1)]


def reduced(rows):
    """One state per key and time: the greatest."""
    out = {}
    for k, t, s in rows:
        if k is not None and t is not None:
            out[k, t] = max(s, out.get((k, t), s))
    return out


@pytest.mark.parametrize("unit", ["day", "month", "year"])
def test_histories_against_brute_force(spark, unit):
    rows = random_log(1)
    log = spark.createDataFrame(rows, "k string, at timestamp, state int")
    one = reduced(rows)
    times = {k: sorted(t for j, t in one if j == k) for k, _ in one}
    want = sorted((k, s, t, min((x for x in times[k] if x > t), default=None)) for (k, t), s in one.items())
    got = sorted((tuple(r) for r in validity(log, ["k"], "at", unit).select("k", "state", "valid_from", "valid_to").collect()))
    assert got == want
    moves = sorted((k, t, one[k, t]) for k in times for i, t in enumerate(times[k]) if i == 0 or one[k, times[k][i - 1]] != one[k, t])
    assert sorted(tuple(r) for r in state_changes(log, ["k"], "at", ["state"], unit).collect()) == moves

    rng = random.Random(2)
    asked = [(i, rng.choice(["a", "b", "c", "d", "e", None]), None if i % 17 == 0 else moment(rng.randrange(-50, 3200))) for i in range(300)]
    asked += [(1000 + i, k, t) for i, (k, t) in enumerate(list(one)[:20])]  # at the very instant of a change
    asked += asked[:3]
    df = spark.createDataFrame(asked, "id long, k string, t timestamp")
    out = as_of_join(df, log, ["k"], "t", "at", unit, prefix="was_")

    def state(k, t):
        before = [x for x in times.get(k, []) if t is not None and x <= t]
        return (max(before), one[k, max(before)]) if before else (None, None)

    assert out.columns == ["id", "k", "t", "was_at", "was_state"]
    assert sorted(map(str, (tuple(r) for r in out.collect()))) == sorted(str((i, k, t, *state(k, t))) for i, k, t in asked)


def test_as_of_join_plan_and_empty_sides(spark):
    log = spark.createDataFrame(random_log(3), "k string, at timestamp, state int")
    df = spark.createDataFrame([(1, "a", moment(9))], "id long, k string, t timestamp")
    plan = as_of_join(df, log, ["k"], "t", "at")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan and "SinglePartition" not in plan
    assert as_of_join(df, log.limit(0), ["k"], "t", "at").collect()[0]["state"] is None
    assert as_of_join(df.limit(0), log, ["k"], "t", "at").count() == 0
    assert validity(log.limit(0), ["k"], "at").count() == 0


@pytest.mark.parametrize("unit", ["day", "month"])
def test_gap_ranges_against_brute_force(spark, unit):
    rng = random.Random(4)
    seen = {(k, moment(h)) for k in range(4) for h in range(0, 1500) if rng.random() < (0.2, 0.9, 0.99, 1.0)[k]}
    seen |= {(9, moment(3))}  # not expected
    df = spark.createDataFrame([*seen, *list(seen)[:5], (None, moment(1)), (0, None)], "k int, at timestamp")
    expected = spark.createDataFrame([(k,) for k in (0, 1, 2, 3, 7, 7)], "k int")
    out = gap_ranges(df, ["k"], "at", "1 hour", (F.lit(moment(0)), F.lit(moment(1520))), expected, unit)
    want = []
    for k in (0, 1, 2, 3, 7):
        run = []
        for h in range(1522):
            if h <= 1520 and (k, moment(h)) not in seen:
                run.append(moment(h))
            elif run:
                want.append((k, run[0], run[-1], len(run)))
                run = []
    assert sorted(tuple(r) for r in out.collect()) == sorted(want)


def test_sql_functions_equal_the_columns(spark):
    register_functions(spark)
    register_functions(spark)  # again, in the same session
    values = [None, -1.0, 0.0, 12.3, 25.0, 25.1, 49.99, 80.0, 160.0, 199.9, 400.0, 400.1, 500.0, 777.7, 1200.0, 9999.0, 120000.0, 1e9]
    df = spark.createDataFrame([(a, b) for a in values for b in values[::3]], "x double, y double")
    df.createOrReplaceTempView("function_values")
    for name, (_, table) in index_columns.SUB_INDEXES.items():
        call = name.replace("aqi_", "index_")
        rows = df.select(F.expr(f"{call}(x)").alias("f"), index_columns.piecewise_index("x", table).alias("c"))
        assert rows.filter("NOT (f <=> c)").count() == 0
    ozone = index_columns.ozone_index(index_columns.piecewise_index("x", index_columns.O3_1H), index_columns.piecewise_index("y", index_columns.O3_8H), "y")
    assert df.select(F.expr("index_ozone(x, y)").alias("f"), ozone.alias("c")).filter("NOT (f <=> c)").count() == 0
    whole = df.select(F.col("x").cast("int").alias("i"), "x", "y")
    pairs = {"health_name(i)": labels.health_label("i"), "hazardous(i)": labels.is_hazardous("i"), "level_name(i)": labels.level_label("i"),
             "day_status(i, x, y)": labels.quality_status("i", "x", "y")}
    for call, column in pairs.items():
        assert whole.select(F.expr(call).alias("f"), column.alias("c")).filter("NOT (f <=> c)").count() == 0
    plan = spark.sql("SELECT index_pm25(x) FROM function_values")._jdf.queryExecution().optimizedPlan().toString()
    assert "index_pm25" not in plan.split("AS index_pm25")[0].replace("index_pm25(x)", "") and "CASE WHEN" in plan  # inlined
