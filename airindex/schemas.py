"""Explicit schemas for every table the library reads or writes.

Passing a schema on read avoids an inference pass over raw files and keeps
column types stable when a file has an empty list or an integral-looking value.
"""

from pyspark.sql import types as T

POLLUTANTS = ("co", "no", "no2", "o3", "so2", "pm2_5", "pm10", "nh3")

# Raw payload: one multi-line JSON object per location-day.
RAW = T.StructType([
    T.StructField("coord", T.StructType([
        T.StructField("lon", T.DoubleType()),
        T.StructField("lat", T.DoubleType()),
    ])),
    T.StructField("list", T.ArrayType(T.StructType([
        T.StructField("dt", T.LongType()),
        T.StructField("main", T.StructType([T.StructField("aqi", T.IntegerType())])),
        T.StructField("components", T.StructType(
            [T.StructField(p, T.DoubleType()) for p in POLLUTANTS])),
    ]))),
])

# Conformed hourly reading.
READING = T.StructType(
    [T.StructField("location_id", T.IntegerType()),
     T.StructField("lon", T.DoubleType()),
     T.StructField("lat", T.DoubleType()),
     T.StructField("measured_at", T.TimestampType()),
     T.StructField("aqi_level", T.IntegerType())]
    + [T.StructField(p, T.DoubleType()) for p in POLLUTANTS]
    + [T.StructField("aqi_label", T.StringType()),
       T.StructField("measure_date", T.DateType()),
       T.StructField("measure_year", T.StringType()),
       T.StructField("measure_month", T.StringType()),
       T.StructField("measure_day", T.StringType())]
)

# Daily fact, keyed by (date_id, location_id), partitioned by measure_date.
FACT_COLUMNS = (
    "date_id", "location_id", "vn_aqi", "dominant_pollutant", "health_implication",
    "is_hazardous", "data_quality_status", "avg_aqi", "max_aqi", "min_aqi",
    "avg_pm2_5", "max_pm2_5", "avg_pm10", "max_pm10", "max_1h_co", "max_1h_no2",
    "max_1h_so2", "max_1h_o3", "max_8h_o3", "avg_co", "avg_no2", "avg_so2", "avg_o3",
    "avg_no", "avg_nh3", "record_count", "measure_date",
)

# Keys and the columns an upsert replaces on a match. The reading key is the location and
# the hour; the fact's natural key is (location_id, measure_date), the same rows as
# (date_id, location_id) since date_id is yyyyMMdd of measure_date.
READING_KEYS = ("location_id", "measured_at")
READING_UPDATE_COLS = ("aqi_level", "co", "no", "no2", "o3", "so2", "pm2_5", "pm10", "nh3",
                       "aqi_label")
FACT_KEYS = ("location_id", "measure_date")
FACT_UPDATE_COLS = tuple(c for c in FACT_COLUMNS if c not in FACT_KEYS + ("date_id",))

# Report extract, in column order. These column names (including
# avg_aqi_owm, the source's own 1-5 level averaged) are the extract's published format.
REPORT = T.StructType([
    T.StructField("measure_date", T.DateType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("day_name", T.StringType()),
    T.StructField("day_of_week", T.IntegerType()),
    T.StructField("city_name", T.StringType()),
    T.StructField("vn_aqi", T.IntegerType()),
    T.StructField("health_implication", T.StringType()),
    T.StructField("dominant_pollutant", T.StringType()),
    T.StructField("is_hazardous", T.BooleanType()),
    T.StructField("data_quality_status", T.StringType()),
    T.StructField("avg_aqi_owm", T.DoubleType()),
    T.StructField("avg_pm2_5", T.DoubleType()),
    T.StructField("max_pm2_5", T.DoubleType()),
    T.StructField("avg_pm10", T.DoubleType()),
    T.StructField("max_pm10", T.DoubleType()),
    T.StructField("avg_co", T.DoubleType()),
    T.StructField("avg_no2", T.DoubleType()),
    T.StructField("avg_so2", T.DoubleType()),
    T.StructField("avg_o3", T.DoubleType()),
    T.StructField("avg_no", T.DoubleType()),
    T.StructField("avg_nh3", T.DoubleType()),
    T.StructField("record_count", T.IntegerType()),
])

# Per-series forecast rows (step = days after the last observed day; 0 = anchor).
FORECAST = ("series_id string, ds date, step int, yhat double, yhat_lower double, "
            "yhat_upper double")
