"""Raw nested payload <-> conformed hourly readings.

``flatten_measurements`` is the raw -> reading step: explode the per-day list of
measurements, keep the parent coordinates, cast nested fields, label the level
and add date parts. ``raw_payload`` goes the other way (one nested object per
location-day), which is how landing files are produced from readings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airindex.functions.dates import date_parts, epoch_to_timestamp, slug
from airindex.functions.labels import level_label
from airindex.schemas import POLLUTANTS


def with_date_parts(df: DataFrame, ts: str = "measured_at") -> DataFrame:
    """Add ``measure_date`` (UTC day) and zero-padded year / month / day strings."""
    out = df.withColumn("measure_date", F.to_date(F.col(ts)))
    return out.withColumns(date_parts("measure_date"))


def flatten_measurements(raw: DataFrame, locations: DataFrame | None = None,
                         carry: tuple[str, ...] = ()) -> DataFrame:
    """Raw payload -> one row per measurement, in the conformed reading layout.

    Empty or NULL lists yield no rows. With ``locations`` (location_id, lon, lat)
    the location id is resolved by an equi-join on the coordinates; a reading whose
    coordinates are not in it keeps a NULL location id (``unmatched_locations``), which a
    keyed upsert returns as a reject. ``carry`` names raw columns (e.g. file metadata) to keep, after the reading columns.
    """
    flat = raw.select(F.col("coord.lon").cast("double").alias("lon"),
                      F.col("coord.lat").cast("double").alias("lat"),
                      F.explode(F.col("list")).alias("m"), *carry)
    cols = [F.col("lon"), F.col("lat"),
            epoch_to_timestamp(F.col("m.dt")).alias("measured_at"),
            F.col("m.main.aqi").cast("int").alias("aqi_level")]
    cols += [F.col(f"m.components.{p}").cast("double").alias(p) for p in POLLUTANTS]
    cols += [F.col(c) for c in carry]
    out = flat.select(*cols).withColumn("aqi_label", level_label("aqi_level"))
    out = with_date_parts(out)
    if carry:
        out = out.select(*[c for c in out.columns if c not in carry], *carry)
    if locations is not None:
        out = out.join(locations.select("location_id", "lon", "lat"), ["lon", "lat"], "left")
        out = out.select("location_id", *[c for c in out.columns if c != "location_id"])
    return out


def unmatched_locations(flat: DataFrame) -> DataFrame:
    """Readings that no known location holds: coordinates, number of readings, first and last."""
    return (flat.filter(F.col("location_id").isNull()).groupBy("lon", "lat")
            .agg(F.count(F.lit(1)).alias("readings"), F.min("measured_at").alias("first_at"),
                 F.max("measured_at").alias("last_at")))


def raw_payload(readings: DataFrame, locations: DataFrame) -> DataFrame:
    """Readings -> one nested object per location-day (the landing layout).

    Each group is one location-day, so ``collect_list`` holds at most a day of
    readings. Adds ``city_slug``, ``yyyy``, ``mm``, ``dd`` for the landing path.
    """
    loc = locations.select("location_id", "city_name")
    item = F.struct(
        F.unix_timestamp("measured_at").alias("dt"),
        F.struct(F.col("aqi_level").alias("aqi")).alias("main"),
        F.struct(*[F.col(p) for p in POLLUTANTS]).alias("components"))
    grouped = (readings.groupBy("location_id", "lon", "lat", "measure_date")
               .agg(F.sort_array(F.collect_list(item)).alias("list")))
    out = grouped.join(loc, "location_id", "inner")
    return out.select(
        F.struct(F.col("lon"), F.col("lat")).alias("coord"), "list",
        slug("city_name").alias("city_slug"),
        F.date_format("measure_date", "yyyy").alias("yyyy"),
        F.date_format("measure_date", "MM").alias("mm"),
        F.date_format("measure_date", "dd").alias("dd"))
