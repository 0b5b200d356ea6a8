"""Table loading and the binding of the driver's test tables to our data model.

``readings_from_events`` turns the ``events`` stream table into conformed hourly
readings: every ``USERS_PER_LOCATION`` consecutive users are a location, so locations grow with
the data and their density does not change, and each event type is one sensor channel, so missing hours and NULL channels arise naturally. The
aggregation is decomposable (partial + final hash aggregate), so a location that
holds a third of all events is combined map-side before the shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airindex.functions.dates import date_parts
from airindex.functions.exact import mean_half_up
from airindex.functions.labels import level_label
from airindex.session import ensure_utc

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Binding of event types to sensor channels, and value scales.
USERS_PER_LOCATION = 20
LEVEL_STEP = 25.0
DECIMALS = 6
VALUE_DECIMALS = 2
CO_PER_VALUE = 400
NATIONS = 25


# Schemas of the source tables the library reads. Passing them skips the footer-reading
# schema-inference job on every load (one small job per query at this scale, one per
# file listing at a large one).
SOURCE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
              "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one test table; Catalyst prunes columns and pushes filters into the scan."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    reader = spark.read
    if name in SOURCE_SCHEMAS:
        reader = reader.schema(SOURCE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def location_coords(location_id: Column) -> dict[str, Column]:
    """Synthetic coordinates of a location (shared by readings and dim_location)."""
    return {"lon": (F.lit(100.0) + location_id).cast("double"),
            "lat": (F.lit(10.0) + location_id).cast("double")}


def _only(event_type: str) -> Column:
    """The event value where the event has the given type (else NULL)."""
    return F.when(F.col("event_type") == F.lit(event_type), F.col("value"))


def _mean(x: Column) -> Column:
    # Event values carry 2 decimals: an exact mean, rounded HALF_UP to 6 places, is the
    # same whatever the order in which partial aggregates meet.
    return mean_half_up(x, DECIMALS, scale=VALUE_DECIMALS)


def location_of(user_id: str = "user_id") -> Column:
    return F.expr(f"{user_id} div {USERS_PER_LOCATION}").cast("int")


def hourly_channels(events: DataFrame) -> DataFrame:
    """events -> one row per (location_id, measured_at) with the raw channel values."""
    ev = events.select("user_id", "ts", "event_type", "value")
    return (ev.groupBy(location_of().alias("location_id"),
                       F.date_trunc("hour", F.col("ts")).alias("measured_at"))
            .agg(_mean(F.col("value")).alias("_mean"),
                 _mean(_only("view")).alias("pm2_5"),
                 _mean(_only("signup")).alias("pm10"),
                 F.max(_only("error")).alias("o3"),
                 (F.max(_only("click")) * F.lit(5)).alias("no2"),
                 (F.max(_only("purchase")) * F.lit(3)).alias("so2"),
                 (F.max("value") * F.lit(CO_PER_VALUE)).alias("co"),
                 F.min("value").alias("no"),
                 F.min(_only("purchase")).alias("nh3")))


def conform(hourly: DataFrame) -> DataFrame:
    """Add coordinates, level, label and date parts: the conformed reading schema."""
    loc = F.col("location_id")
    level = F.least(F.lit(5), F.floor(F.col("_mean") / LEVEL_STEP) + 1).cast("int")
    day = F.to_date("measured_at")
    coords = location_coords(loc)
    return hourly.select(
        "location_id", coords["lon"].alias("lon"), coords["lat"].alias("lat"), "measured_at",
        level.alias("aqi_level"), "co", "no", "no2", "o3", "so2", "pm2_5", "pm10", "nh3",
        level_label(level).alias("aqi_label"), day.alias("measure_date"),
        *[c.alias(n) for n, c in date_parts(day).items()])


def readings_from_events(events: DataFrame) -> DataFrame:
    return conform(hourly_channels(events))


def readings(spark: SparkSession, sf_dir: str, start=None, end=None,
             lead_days: int = 0) -> DataFrame:
    """Conformed hourly readings derived from the ``events`` table.

    With ``start`` / ``end`` (UTC days, inclusive) only events of
    ``[start - lead_days, end]`` are read: the range is a filter on ``ts`` itself,
    so it reaches the parquet scan (row groups outside it are skipped by their
    statistics). Use ``lead_days=1`` before ``daily_air_index(start, end)``, whose
    ozone window needs the day before the range.
    """
    ensure_utc(spark)
    events = load(spark, sf_dir, "events")
    if start is not None or end is not None:
        ts = F.col("ts")
        if start is not None:
            first = _as_day(start) - dt.timedelta(days=lead_days)
            events = events.filter(ts >= F.lit(dt.datetime.combine(first, dt.time()))
                                   .cast("timestamp_ntz"))
        if end is not None:
            after = _as_day(end) + dt.timedelta(days=1)
            events = events.filter(ts < F.lit(dt.datetime.combine(after, dt.time()))
                                   .cast("timestamp_ntz"))
    return readings_from_events(events)


def reading_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """measure_date of every event, from the ``ts`` column alone: for spans of days, which need no readings."""
    ensure_utc(spark)
    return load(spark, sf_dir, "events").select(F.to_date("ts").alias("measure_date"))


def _as_day(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(d)


def dim_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The locations of ``events``, each named after a nation and its own number."""
    ids = load(spark, sf_dir, "events").select(location_of().alias("location_id")).distinct()
    nation = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    loc = F.col("location_id")
    named = ids.withColumn("n_nationkey", loc % NATIONS).join(nation, "n_nationkey")
    return named.select(loc, F.concat_ws(" ", "n_name", loc.cast("string")).alias("city_name"),
                        *[c.alias(n) for n, c in location_coords(loc).items()])
