"""Command-line jobs end to end on hand-made landing files; range globs."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from airindex.plans.jobs import main
from airindex.sources.raw import range_glob


def _land(root, city, day, lon, lat, hours, pm25=12.5):
    path = os.path.join(root, city, f"{day:%Y}", f"{day:%m}", f"{day:%d}.json")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    start = int(dt.datetime(day.year, day.month, day.day, tzinfo=dt.timezone.utc).timestamp())
    items = [{"dt": start + 3600 * h, "main": {"aqi": 2},
              "components": {"o3": 50.0 + h, "pm2_5": pm25, "pm10": 30.0, "co": 500.0,
                             "no2": 20.0, "so2": 10.0}} for h in hours]
    with open(path, "w") as fh:
        json.dump({"coord": {"lon": lon, "lat": lat}, "list": items}, fh, indent=4)


def test_range_glob():
    g = range_glob("/r", "2024-01-30", "2024-03-02")
    assert g == "/r/*/{2024/01/30,2024/01/31,2024/02/*,2024/03/01,2024/03/02}*.json"


def test_jobs_end_to_end(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    locs = os.path.join(tmp_dir, "locations")
    readings, fact, out = (os.path.join(tmp_dir, n) for n in ("readings", "fact", "out"))
    spark.createDataFrame([(0, "Alpha City", 100.0, 10.0), (1, "Beta", 101.0, 11.0)],
                          "location_id int, city_name string, lon double, lat double"
                          ).write.parquet(locs)
    d1, d2, d4 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 4)
    _land(landing, "alpha_city", d1, 100.0, 10.0, range(24))
    _land(landing, "alpha_city", d2, 100.0, 10.0, range(24))
    _land(landing, "beta", d2, 101.0, 11.0, range(10))
    _land(landing, "beta", d4, 101.0, 11.0, range(20))   # day 3 has no files at all
    args = ["--landing", landing, "--locations", locs, "--readings", readings]
    assert main(["conform", *args, "--start", "2024-01-01", "--end", "2024-01-04"],
                spark) == 0
    assert main(["conform", *args, "--start", "2024-01-01", "--end", "2024-01-04"],
                spark) == 0  # idempotent
    r = spark.read.parquet(readings)
    assert r.count() == 24 + 24 + 10 + 20
    assert main(["fact", "--readings", readings, "--fact", fact, "--start", "2024-01-02",
                 "--end", "2024-01-04"], spark) == 0
    f = spark.read.parquet(fact).orderBy("measure_date", "location_id").collect()
    assert [(x.location_id, x.measure_date, x.record_count, x.data_quality_status) for x in f] == [
        (0, d2, 24, "Valid"), (1, d2, 10, "Insufficient Data (<75%)"), (1, d4, 20, "Valid")]
    # PM2.5 12.5 -> 25 index; PM10 30 -> 30; the rest lower: index 30, dominant PM10
    assert f[0].vn_aqi == 30 and f[0].dominant_pollutant == "PM10"
    # the 8-hour ozone of day 2 at 00:00 used day 1's last 7 hours (halo): max is at 23:00
    assert f[0].max_8h_o3 == round(sum(50.0 + h for h in range(16, 24)) / 8, 2)
    assert main(["export", "--fact", fact, "--locations", locs, "--out", out], spark) == 0
    csv = spark.read.option("header", True).csv(out)
    assert csv.count() == 3 and set(csv.columns) >= {"city_name", "avg_aqi_owm", "vn_aqi"}
    assert csv.filter(F.col("city_name") == "Alpha City").count() == 1
