"""Keyed upsert: merge semantics, duplicates, NULL keys, idempotence, touched partitions."""

import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from airindex.operators.upsert import (affected_dates, as_of, evolve_union, latest_per_key,
                                       merge_frames, null_key_rows, replace_by_key,
                                       upsert_partitioned)

SCHEMA = "k int, d date, v double, note string"
D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)


def _set(df):
    return sorted(tuple(r) for r in df.collect())


def test_merge_matched_unmatched(spark):
    target = spark.createDataFrame([(1, D1, 1.0, "t"), (2, D1, 2.0, "t")], SCHEMA)
    updates = spark.createDataFrame([(2, D1, 20.0, "u"), (3, D2, 30.0, "u")], SCHEMA)
    out = merge_frames(target, updates, ["k"], update_cols=["v"])
    assert _set(out) == [(1, D1, 1.0, "t"), (2, D1, 20.0, "t"), (3, D2, 30.0, "u")]


def test_empty_sides(spark):
    target = spark.createDataFrame([(1, D1, 1.0, "t")], SCHEMA)
    empty = spark.createDataFrame([], SCHEMA)
    assert _set(merge_frames(empty, target, ["k"])) == [(1, D1, 1.0, "t")]
    assert _set(merge_frames(target, empty, ["k"])) == [(1, D1, 1.0, "t")]


def test_duplicates_latest_wins_and_null_keys(spark):
    target = spark.createDataFrame([(1, D1, 1.0, "t")], SCHEMA)
    updates = spark.createDataFrame(
        [(1, D1, 5.0, "a", 1), (1, D1, 7.0, "b", 2), (None, D1, 9.0, "n", 3)],
        SCHEMA + ", seq int")
    out = merge_frames(target, updates, ["k"], order_by="seq")
    assert _set(out) == [(1, D1, 7.0, "b")]
    assert null_key_rows(updates, ["k"]).count() == 1


def test_latest_per_key_null_order(spark):
    df = spark.createDataFrame([(1, D1, 5.0, "a", None), (1, D1, 7.0, "b", 3),
                                (2, D1, 9.0, "c", None)], SCHEMA + ", seq int")
    got = _set(latest_per_key(df, ["k"], "seq").select("k", "v"))
    assert got == [(1, 7.0), (2, 9.0)]


def test_latest_per_key_skewed_key(spark):
    # One key holds most rows: the grouped max_by reduces it map-side.
    rows = [(1, D1, float(i), "x", i) for i in range(1000)] + [(2, D1, 0.0, "y", 0)]
    df = spark.createDataFrame(rows, SCHEMA + ", seq int")
    got = _set(latest_per_key(df, ["k"], "seq").select("k", "v"))
    assert got == [(1, 999.0), (2, 0.0)]


def test_merge_twice_is_once(spark):
    target = spark.createDataFrame([(1, D1, 1.0, "t"), (2, D1, 2.0, "t")], SCHEMA)
    updates = spark.createDataFrame([(2, D1, 20.0, "u"), (3, D2, 30.0, "u")], SCHEMA)
    once = merge_frames(target, updates, ["k"])
    twice = merge_frames(once, updates, ["k"])
    assert _set(once) == _set(twice)


def test_replace_by_key_equals_full_merge(spark):
    target = spark.createDataFrame([(1, D1, 1.0, "t"), (2, D1, 2.0, "t")], SCHEMA)
    updates = spark.createDataFrame([(2, D1, 20.0, "u"), (3, D2, 30.0, "u")], SCHEMA)
    assert _set(replace_by_key(target, updates, ["k"])) == _set(
        merge_frames(target, updates, ["k"]))


def test_upsert_partitioned_touches_only_updated_days(spark, tmp_dir):
    path = os.path.join(tmp_dir, "table")
    base = spark.createDataFrame([(1, D1, 1.0, "t"), (2, D2, 2.0, "t"), (3, D3, 3.0, "t")],
                                 SCHEMA)
    upsert_partitioned(spark, path, base, ["k"], "d")
    before = {p: os.path.getmtime(p) for p in glob.glob(f"{path}/d=*/*.parquet")}
    updates = spark.createDataFrame([(2, D2, 20.0, "u"), (4, D2, 40.0, "u"),
                                     (None, D2, 0.0, "n")], SCHEMA)
    rejects = upsert_partitioned(spark, path, updates, ["k"], "d", update_cols=["v"])
    assert rejects.count() == 1
    after = {p: os.path.getmtime(p) for p in glob.glob(f"{path}/d=*/*.parquet")}
    untouched = [p for p in before if "d=2024-01-02" not in p]
    assert all(p in after and after[p] == before[p] for p in untouched)
    first = _set(spark.read.schema(SCHEMA).parquet(path).select("k", "v", "note"))
    assert first == [(1, 1.0, "t"), (2, 20.0, "t"), (3, 3.0, "t"), (4, 40.0, "u")]
    # Applying the same updates again changes nothing.
    upsert_partitioned(spark, path, updates, ["k"], "d", update_cols=["v"])
    assert _set(spark.read.schema(SCHEMA).parquet(path).select("k", "v", "note")) == first


def test_as_of_and_evolve(spark):
    log = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (2, 3, "d")],
                                "k int, version int, v string")
    assert _set(as_of(log, ["k"], 1).select("k", "v")) == [(1, "a"), (2, "c")]
    assert _set(as_of(log, ["k"], 2).select("k", "v")) == [(1, "b"), (2, "c")]
    old = spark.createDataFrame([(1, "x")], "k int, a string")
    new = spark.createDataFrame([(2, 5.0)], "k int, b double")
    assert _set(evolve_union(old, new).select("k", "a", "b")) == [(1, "x", None), (2, None, 5.0)]


def test_late_reading_affects_two_days(spark):
    upd = spark.createDataFrame([(3, D2)], "location_id int, measure_date date")
    assert _set(affected_dates(upd)) == [(3, D2), (3, D3)]
    assert F is not None


def test_merge_into_table_needs_row_level_support(spark, tmp_dir):
    import pytest
    from pyspark.errors import AnalysisException, UnsupportedOperationException
    from airindex.operators.upsert import merge_into_table
    name = "merge_target_" + os.path.basename(tmp_dir).replace("-", "_")
    (spark.createDataFrame([(1, D1, 1.0, "t")], SCHEMA).write
     .option("path", os.path.join(tmp_dir, "t")).saveAsTable(name))
    updates = spark.createDataFrame([(1, D1, 5.0, "u")], SCHEMA)
    # A plain parquet table has no row-level operations: the MERGE is refused as such.
    with pytest.raises((AnalysisException, UnsupportedOperationException)) as err:
        merge_into_table(updates, name, ["k"], ["v"])
    assert "UNSUPPORTED_FEATURE" in str(err.value) and "MERGE INTO" in str(err.value)
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_tie_winner_does_not_depend_on_row_order(spark):
    rows = [(1, D1, 5.0, "a", 7), (1, D1, 5.0, "b", 7), (1, D1, 4.0, "c", 7)]
    for order in (rows, rows[::-1], [rows[1], rows[2], rows[0]]):
        df = spark.createDataFrame(order, SCHEMA + ", seq int").coalesce(1)
        assert _set(latest_per_key(df, ["k"], "seq").select("k", "v", "note")) == [(1, 5.0, "b")]


def test_upsert_keeps_stored_columns_and_adds_new_ones(spark, tmp_dir):
    path = os.path.join(tmp_dir, "wide")
    base = spark.createDataFrame([(1, D1, 1.0, "kept"), (2, D1, 2.0, "kept"), (9, D3, 9.0, "old")],
                                 "k int, d date, v double, extra string")
    upsert_partitioned(spark, path, base, ["k"], "d")
    late = spark.createDataFrame([(2, D1, 20.0, 5), (3, D1, 30.0, 6)], "k int, d date, v double, newcol int")
    upsert_partitioned(spark, path, late, ["k"], "d")
    table = spark.read.option("mergeSchema", True).parquet(path)
    assert _set(table.select("k", "v", "extra", "newcol")) == [
        (1, 1.0, "kept", None), (2, 20.0, "kept", 5), (3, 30.0, None, 6), (9, 9.0, "old", None)]


def test_upsert_type_conflict_and_repeated_target_keys_fail(spark, tmp_dir):
    import pytest
    path = os.path.join(tmp_dir, "strict")
    base = spark.createDataFrame([(1, D1, 1.0, "t")], SCHEMA)
    upsert_partitioned(spark, path, base, ["k"], "d")
    with pytest.raises(ValueError, match="column v is double"):
        upsert_partitioned(spark, path, spark.createDataFrame([(1, D1, "x", "t")], "k int, d date, v string, note string"), ["k"], "d")
    base.withColumn("k", F.lit(1)).write.mode("append").partitionBy("d").parquet(path)
    with pytest.raises(ValueError, match="more than once"):
        upsert_partitioned(spark, path, base, ["k"], "d")


def test_upsert_reads_its_source_once_and_leaves_nothing(spark, tmp_dir):
    from airindex.session import checkpoint_dir
    scratch = os.path.join(checkpoint_dir(spark).replace("file:", ""), "airindex-scratch")
    before = set(os.listdir(scratch)) if os.path.isdir(scratch) else set()
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    path = os.path.join(tmp_dir, "once")
    rows = spark.createDataFrame([(1, D1, 1.0, "t"), (2, D2, 2.0, "t")], SCHEMA)
    for n in (1, 2):
        rejects = upsert_partitioned(spark, path, rows.mapInArrow(count, SCHEMA), ["k"], "d")
        assert rejects.count() == 0 and seen.value == 2 * n
    assert set(os.listdir(scratch)) == before


def test_table_by_name(spark, tmp_dir):
    import pytest
    from airindex.sinks.catalog_tables import create_table, table_path, upsert_table
    name = "named_" + os.path.basename(tmp_dir).replace("-", "_")
    rows = spark.createDataFrame([(1, D1, 1.0, "t"), (2, D2, 2.0, "t")], SCHEMA)
    create_table(spark, name, rows.schema, "d", os.path.join(tmp_dir, "place"))
    create_table(spark, name, rows.schema, "d", os.path.join(tmp_dir, "elsewhere"))
    assert table_path(spark, name).endswith("/place") and spark.table(name).count() == 0
    upsert_table(spark, name, rows, ["k"], "d")
    upsert_table(spark, name, rows.withColumn("v", F.col("v") * 10).filter("k = 2"), ["k"], "d", ["v"])
    assert _set(spark.table(name).select("k", "v")) == [(1, 1.0), (2, 20.0)]
    with pytest.raises(ValueError, match="columns missing"):
        upsert_table(spark, name, rows.drop("note"), ["k"], "d")
    spark.sql(f"DROP TABLE {name}")
