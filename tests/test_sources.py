"""Raw landing files, request plan, report CSV round trip, latest export."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from airindex.operators.conform import flatten_measurements
from airindex.operators.star import dim_date, star_report
from airindex.sinks.files import latest_export, read_report_csv, write_csv
from airindex.sources.raw import day_glob, read_raw, request_plan


def _write(path, obj):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        json.dump(obj, fh, indent=4)


def _item(dt_, aqi=2, **comp):
    return {"dt": dt_, "main": {"aqi": aqi}, "components": comp}


def test_missing_path_is_empty(spark, tmp_dir):
    df = read_raw(spark, os.path.join(tmp_dir, "nope", "*.json"))
    assert df.count() == 0
    assert flatten_measurements(df).count() == 0


def test_raw_edge_cases(spark, tmp_dir):
    root = os.path.join(tmp_dir, "landing")
    # a full file with an integer-valued pollutant and one pollutant absent everywhere
    _write(f"{root}/city_a/2024/01/05.json",
           {"coord": {"lon": 1.5, "lat": 2.5},
            "list": [_item(1704412800, co=200, no2=1.5), _item(1704416400, aqi=9, co=201.25)]})
    _write(f"{root}/city_b/2024/01/05.json", {"coord": {"lon": 3.0, "lat": 4.0}, "list": []})
    _write(f"{root}/city_c/2024/01/05.json", {"coord": {"lon": 5.0, "lat": 6.0}})
    raw = read_raw(spark, day_glob(root, "2024-01-05"))
    assert raw.count() == 3
    assert raw.filter(F.size("list") > 0).count() == 1
    flat = flatten_measurements(raw).orderBy("measured_at").collect()
    assert len(flat) == 2
    assert flat[0].co == 200.0 and flat[0].no2 == 1.5 and flat[0].nh3 is None
    assert flat[0].measured_at == dt.datetime(2024, 1, 5, 0, 0)
    assert flat[0].measure_date == dt.date(2024, 1, 5) and flat[0].measure_day == "05"
    assert flat[1].aqi_label == "Unknown" and flat[0].aqi_label == "Fair"


def test_request_plan_window(spark):
    locs = spark.createDataFrame([(0, "Alpha River City", 101.5, 11.5)],
                                 "location_id int, city_name string, lon double, lat double")
    rows = request_plan(locs, "2020-11-25", "2020-11-26").orderBy("request_date").collect()
    assert len(rows) == 2
    assert rows[0].start_epoch == 1606262400 and rows[0].end_epoch == 1606262400 + 86399
    assert rows[0].object_key == "alpha_river_city/2020/11/25.json"


def _fact(spark, rows):
    cols = ("date_id int, location_id int, vn_aqi int, dominant_pollutant string, "
            "health_implication string, is_hazardous boolean, data_quality_status string, "
            "avg_aqi double, avg_pm2_5 double, max_pm2_5 double, avg_pm10 double, "
            "max_pm10 double, avg_co double, avg_no2 double, avg_so2 double, avg_o3 double, "
            "avg_no double, avg_nh3 double, record_count int, measure_date date")
    return spark.createDataFrame(rows, cols)


def test_star_report_inner_and_csv_round_trip(spark, tmp_dir):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    fact = _fact(spark, [
        (20240101, 0, None, None, "N/A", False, "Insufficient Data (<75%)", 1.5, None, None,
         2.0, 3.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 10, d1),
        (20240102, 0, 210, "CO", "Very Unhealthy", True, "Valid", 2.0, 1.0, 2.0, 2.0, 3.0,
         1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 24, d2),
        (20240102, 99, 10, "PM2.5", "Good", False, "Valid", 2.0, 1.0, 2.0, 2.0, 3.0, 1.0,
         1.0, 1.0, 1.0, 1.0, 1.0, 24, d2),  # no location row: drops out
    ])
    locs = spark.createDataFrame([(0, "Alpha")], "location_id int, city_name string")
    rep = star_report(fact, dim_date(spark, d1, d2), locs)
    rows = rep.collect()
    assert [r.measure_date for r in rows] == [d1, d2]
    assert rows[0].day_name == "Monday" and rows[0].day_of_week == 1
    path = os.path.join(tmp_dir, "report")
    write_csv(rep, path)
    back = read_report_csv(spark, path).orderBy("measure_date").collect()
    assert back[0].vn_aqi is None and back[0].avg_pm2_5 is None
    assert back[1].is_hazardous is True and back[0].is_hazardous is False
    assert [tuple(r) for r in back] == [tuple(r) for r in rows]
    # KPIs straight from the extract read back (the dashboard's path)
    from airindex.operators.quality import kpi_summary
    k = kpi_summary(read_report_csv(spark, path)).first()
    assert (k.total_days, k.valid_days, k.issue_days, k.completeness_pct) == (2, 1, 1, 50.0)
    assert k.avg_vn_aqi == 210.0 and k.max_pm2_5 == 2.0


def test_latest_export(spark, tmp_dir):
    root = os.path.join(tmp_dir, "exports")
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(2,), (3,)], "x int")
    a.write.parquet(f"{root}/export=1")
    b.write.parquet(f"{root}/export=2")
    got = sorted(r.x for r in latest_export(spark.read.parquet(root), root).collect())
    assert got == [2, 3]


def test_coverage_gaps_missing_day_and_silent_location(spark):
    from airindex.operators.quality import coverage_gaps
    d = [dt.date(2024, 1, i) for i in (1, 2, 3)]
    r = spark.createDataFrame([(0, d[0]), (0, d[2]), (1, d[0]), (1, d[1]), (1, d[2])],
                              "location_id int, measure_date date")
    locs = spark.createDataFrame([(0, "A"), (1, "B"), (2, "C")],
                                 "location_id int, city_name string")
    got = sorted((x.location_id, x.measure_date) for x in coverage_gaps(r, locs).collect())
    assert got == [(0, d[1]), (2, d[0]), (2, d[1]), (2, d[2])]


def test_single_file_csv_option(spark, tmp_dir):
    import glob
    df = spark.range(100).repartition(4).withColumn("y", F.col("id") * 2)
    out = os.path.join(tmp_dir, "one")
    write_csv(df, out, single_file=True)
    assert len(glob.glob(os.path.join(out, "part-*.csv"))) == 1
    assert spark.read.option("header", True).csv(out).count() == 100


def test_absent_paths_are_left_out_and_reported(spark, tmp_dir):
    from airindex.sources.raw import read_landed_days, write_raw_by_day
    root = os.path.join(tmp_dir, "landing")
    _write(f"{root}/a/2024/01/05.json", {"coord": {"lon": 1.5, "lat": 2.5}, "list": [_item(1704412800, co=1)]})
    missing = []
    df = read_raw(spark, [f"{root}/a/2024/01/05.json", f"{root}/b/nope.json"], missing=missing)
    assert df.count() == 1 and missing == [f"{root}/b/nope.json"]
    assert read_landed_days(spark, os.path.join(tmp_dir, "none"), "2024-01-01", "2024-01-02").count() == 0
    days = df.select("coord", "list", F.lit("2024").alias("yyyy"), F.lit("01").alias("mm"),
                     F.explode(F.array(F.lit("05"), F.lit("06"), F.lit("07"))).alias("dd"), F.lit("a").alias("city_slug"))
    write_raw_by_day(days, os.path.join(tmp_dir, "by-day"))
    ranged = read_landed_days(spark, os.path.join(tmp_dir, "by-day"), "2024-01-06", "2024-01-07")
    assert ranged.count() == 2 and ranged.columns == ["coord", "list"]
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(landing_day" in plan


def test_unmatched_coordinates_are_kept_and_counted(spark):
    from airindex.operators.conform import unmatched_locations
    from airindex.schemas import RAW
    raw = spark.createDataFrame([({"lon": 1.0, "lat": 2.0}, [{"dt": 0, "main": {"aqi": 1}, "components": {}}]),
                                 ({"lon": 8.0, "lat": 9.0}, [{"dt": 60, "main": {"aqi": 1}, "components": {}}])], RAW)
    locs = spark.createDataFrame([(4, 1.0, 2.0)], "location_id int, lon double, lat double")
    flat = flatten_measurements(raw, locs)
    assert sorted((r.location_id is None, r.lon) for r in flat.collect()) == [(False, 1.0), (True, 8.0)]
    assert [(r.lon, r.lat, r.readings) for r in unmatched_locations(flat).collect()] == [(8.0, 9.0, 1)]
