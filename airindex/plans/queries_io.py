"""Source, sink, upsert and report queries.

Upsert fixtures: the target holds days 1-20 of each month, the updates days 18 and
later (with a changed value), so 18-20 are updated, 21+ inserted, the rest kept.
Round-trip queries write below the shared checkpoint folder and read back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from airindex.functions.dates import is_process_date
from airindex.functions.labels import STATUS_VALID
from airindex.operators.conform import flatten_measurements, raw_payload, unmatched_locations
from airindex.operators.star import dim_date_spanning, star_report
from airindex.operators.upsert import (affected_dates, as_of, evolve_union, merge_frames,
                                       replace_by_key)
from airindex.plans import oracle as O
from airindex.plans.catalog import register
from airindex.plans.daily import daily_air_index, two_day_buffer
from airindex.schemas import (FACT_COLUMNS, FACT_KEYS, FACT_UPDATE_COLS, READING,
                              READING_KEYS, READING_UPDATE_COLS)
from airindex.session import scratch_path
from airindex.sinks.files import latest_export, read_report_csv, write_csv, write_partitioned
from airindex.sources.raw import DAY, read_raw, request_plan, write_raw_by_day
from airindex.sources.tables import dim_location, load, reading_days, readings

READING_COLUMNS = [f.name for f in READING.fields]
SPLIT_LAST_TARGET_DAY = 20
SPLIT_FIRST_UPDATE_DAY = 18


def _day():
    return F.dayofmonth("measure_date")


def reading_target(r):
    return r.filter(_day() <= SPLIT_LAST_TARGET_DAY)


def reading_updates(r):
    return r.filter(_day() >= SPLIT_FIRST_UPDATE_DAY).withColumn("pm2_5", F.col("pm2_5") + F.lit(1))


READING_SPLIT_SQL = f""",
target AS (SELECT * FROM readings WHERE day(measure_date) <= {SPLIT_LAST_TARGET_DAY}),
updates AS (SELECT * REPLACE (pm2_5 + 1 AS pm2_5) FROM readings
            WHERE day(measure_date) >= {SPLIT_FIRST_UPDATE_DAY})"""


def merge_sql(cols, keys, update_cols, target="target", updates="updates") -> str:
    in_t, in_u = f"t.{keys[0]} IS NOT NULL", f"u.{keys[0]} IS NOT NULL"
    out = []
    for c in cols:
        if c in keys:
            out.append(f"coalesce(t.{c}, u.{c}) AS {c}")
        elif c in update_cols:
            out.append(f"CASE WHEN {in_u} THEN u.{c} ELSE t.{c} END AS {c}")
        else:
            out.append(f"CASE WHEN {in_t} THEN t.{c} ELSE u.{c} END AS {c}")
    on = " AND ".join(f"t.{k} = u.{k}" for k in keys)
    return f"SELECT {', '.join(out)} FROM {target} t FULL OUTER JOIN {updates} u ON {on}"


@register("upsert_readings", O.with_readings(
    READING_SPLIT_SQL + "\n" + merge_sql(READING_COLUMNS, READING_KEYS, READING_UPDATE_COLS)))
def q_upsert_readings(spark, sf_dir):
    r = readings(spark, sf_dir)
    return merge_frames(reading_target(r), reading_updates(r), READING_KEYS, READING_UPDATE_COLS)


@register("upsert_anti_union", O.with_readings(READING_SPLIT_SQL + f"""
SELECT * FROM target t WHERE NOT EXISTS (
  SELECT 1 FROM updates u WHERE u.location_id = t.location_id AND u.measured_at = t.measured_at)
UNION ALL SELECT {O.READING_COLS} FROM updates"""))
def q_upsert_anti_union(spark, sf_dir):
    r = readings(spark, sf_dir)
    return replace_by_key(reading_target(r), reading_updates(r), READING_KEYS)


@register("upsert_daily_fact", O.with_fact(f""",
target AS (SELECT * FROM fact WHERE day(measure_date) <= {SPLIT_LAST_TARGET_DAY}),
updates AS (SELECT * REPLACE (record_count + 100 AS record_count) FROM fact
            WHERE day(measure_date) >= {SPLIT_FIRST_UPDATE_DAY})
{merge_sql(FACT_COLUMNS, FACT_KEYS, FACT_UPDATE_COLS)}"""))
def q_upsert_daily_fact(spark, sf_dir):
    fact = daily_air_index(readings(spark, sf_dir))
    target = fact.filter(_day() <= SPLIT_LAST_TARGET_DAY)
    updates = (fact.filter(_day() >= SPLIT_FIRST_UPDATE_DAY)
               .withColumn("record_count", F.col("record_count") + F.lit(100)))
    return merge_frames(target, updates, FACT_KEYS, FACT_UPDATE_COLS)


_AS_OF_COLS = "location_id, measured_at, version, pm2_5, pm10, o3"


@register("as_of_version", O.with_readings(READING_SPLIT_SQL + f""",
log AS (SELECT *, 1 AS version FROM target UNION ALL SELECT *, 2 AS version FROM updates),
versions AS (SELECT 1 AS as_of UNION ALL SELECT 2 AS as_of),
ranked AS (SELECT l.*, a.as_of, row_number() OVER (
             PARTITION BY a.as_of, l.location_id, l.measured_at ORDER BY l.version DESC) AS rn
           FROM log l JOIN versions a ON l.version <= a.as_of)
SELECT as_of, {_AS_OF_COLS} FROM ranked WHERE rn = 1"""))
def q_as_of_version(spark, sf_dir):
    r = readings(spark, sf_dir)
    log = (reading_target(r).withColumn("version", F.lit(1))
           .unionByName(reading_updates(r).withColumn("version", F.lit(2))))
    cols = [c.strip() for c in _AS_OF_COLS.split(",")]
    v1 = as_of(log, READING_KEYS, 1).select(F.lit(1).alias("as_of"), *cols)
    v2 = as_of(log, READING_KEYS, 2).select(F.lit(2).alias("as_of"), *cols)
    return v1.unionByName(v2)


@register("evolve_union", O.with_readings("""
SELECT * EXCLUDE (nh3, aqi_label) FROM readings WHERE day(measure_date) <= 15
UNION ALL BY NAME
SELECT *, 'v2' AS source FROM readings WHERE day(measure_date) > 15"""))
def q_evolve_union(spark, sf_dir):
    r = readings(spark, sf_dir)
    old = r.filter(_day() <= 15).drop("nh3", "aqi_label")
    new = r.filter(_day() > 15).withColumn("source", F.lit("v2"))
    return evolve_union(old, new)


@register("affected_dates", O.with_readings("""
, touched AS (SELECT DISTINCT location_id, measure_date FROM readings)
SELECT location_id, measure_date FROM touched
UNION SELECT location_id, measure_date + 1 FROM touched"""))
def q_affected_dates(spark, sf_dir):
    return affected_dates(readings(spark, sf_dir))


_SCAN = O.with_readings(f"SELECT {O.READING_COLS} FROM readings")


@register("flatten_measurements", _SCAN)
def q_flatten_measurements(spark, sf_dir):
    locs = dim_location(spark, sf_dir)
    raw = raw_payload(readings(spark, sf_dir), locs)
    return flatten_measurements(raw, locs).select(*READING_COLUMNS)


@register("bronze_json_roundtrip", _SCAN)
def q_bronze_json_roundtrip(spark, sf_dir):
    """Readings -> nested JSON landing files by day -> read by a glob of days, with schema -> flatten."""
    locs = dim_location(spark, sf_dir)
    root = scratch_path(spark, "landing")
    write_raw_by_day(raw_payload(readings(spark, sf_dir), locs), root)
    raw = read_raw(spark, f"{root}/{DAY}=*/*.json", multi_line=False)
    return flatten_measurements(raw, locs).select(*READING_COLUMNS)


@register("write_partitioned", _SCAN)
def q_write_partitioned(spark, sf_dir):
    path = scratch_path(spark, "readings")
    write_partitioned(readings(spark, sf_dir), path, "measure_date")
    return spark.read.schema(READING).parquet(path).select(*READING_COLUMNS)


@register("two_day_buffer", O.with_readings(
    f"SELECT {O.READING_COLS} FROM readings WHERE measure_date BETWEEN "
    "(SELECT max(measure_date) FROM readings) - 1 AND (SELECT max(measure_date) FROM readings)"))
def q_two_day_buffer(spark, sf_dir):
    return two_day_buffer(readings(spark, sf_dir)).select(*READING_COLUMNS)


@register("request_plan", O.with_readings(""",
span AS (SELECT min(measure_date) AS s, max(measure_date) AS e FROM readings),
days AS (SELECT location_id, city_name AS n_name, cast(g.d AS date) AS request_date
         FROM dim_location, span, generate_series(span.s, span.e, INTERVAL 1 DAY) AS g(d))
SELECT location_id, request_date, cast(100.0 + location_id AS double) AS lon,
       cast(10.0 + location_id AS double) AS lat,
       cast(epoch(cast(request_date AS timestamp)) AS bigint) AS start_epoch,
       cast(epoch(cast(request_date AS timestamp)) AS bigint) + 86399 AS end_epoch,
       replace(lower(n_name), ' ', '_') AS city_slug,
       replace(lower(n_name), ' ', '_') || '/' || strftime(request_date, '%Y') || '/' ||
         strftime(request_date, '%m') || '/' || strftime(request_date, '%d') || '.json'
         AS object_key
FROM days"""))
def q_request_plan(spark, sf_dir):
    return request_plan(dim_location(spark, sf_dir), dates=reading_days(spark, sf_dir))


STAR_SQL = O.with_fact(f""",
span AS (SELECT min(measure_date) AS s, max(measure_date) AS e FROM fact),
dd AS (SELECT cast(g.d AS date) AS measure_date
       FROM span, generate_series(span.s, span.e, INTERVAL 1 DAY) AS g(d)),
dim_date AS (SELECT {O.date_id_sql('measure_date')} AS date_id, measure_date,
                    cast(year(measure_date) AS int) AS year,
                    cast(month(measure_date) AS int) AS month,
                    dayname(measure_date) AS day_name,
                    cast(isodow(measure_date) AS int) AS day_of_week FROM dd)
SELECT d.measure_date, d.year, d.month, d.day_name, d.day_of_week, l.city_name, f.vn_aqi,
       f.health_implication, f.dominant_pollutant, f.is_hazardous, f.data_quality_status,
       f.avg_aqi AS avg_aqi_owm, f.avg_pm2_5, f.max_pm2_5, f.avg_pm10, f.max_pm10, f.avg_co,
       f.avg_no2, f.avg_so2, f.avg_o3, f.avg_no, f.avg_nh3, f.record_count
FROM fact f JOIN dim_date d ON f.date_id = d.date_id
JOIN dim_location l ON f.location_id = l.location_id""")


def report(spark, sf_dir, fact=None):
    """Star report; the calendar spans the source readings (a ``ts``-only scan)."""
    fact = fact if fact is not None else daily_air_index(readings(spark, sf_dir))
    return star_report(fact, dim_date_spanning(reading_days(spark, sf_dir)), dim_location(spark, sf_dir))


@register("star_report", STAR_SQL)
def q_star_report(spark, sf_dir):
    return report(spark, sf_dir)


@register("report_csv_roundtrip", STAR_SQL)
def q_report_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "report")
    write_csv(report(spark, sf_dir), path)
    return read_report_csv(spark, path)


@register("latest_file", STAR_SQL)
def q_latest_file(spark, sf_dir):
    """Two exports (a partial one, then the full one): the newest must be selected."""
    root = scratch_path(spark, "exports")
    full = report(spark, sf_dir)
    write_csv(full.filter(F.dayofmonth("measure_date") <= 15), f"{root}/export=1")
    write_csv(full, f"{root}/export=2")
    df = read_report_csv(spark, root)
    return latest_export(df, root, "export").drop("export")


ADHOC_SQL = f"""
SELECT l.city_name, d.year, d.month, count(*) AS days,
       cast(count_if(f.data_quality_status = '{STATUS_VALID}') AS bigint) AS valid_days,
       max(f.vn_aqi) AS max_vn_aqi, max(f.max_pm2_5) AS max_pm2_5
FROM fact_air_quality f
JOIN dim_date d ON f.date_id = d.date_id
JOIN dim_location l ON f.location_id = l.location_id
GROUP BY l.city_name, d.year, d.month"""


@register("adhoc_sql_report", STAR_SQL.split("\nSELECT d.measure_date")[0]
          + ",\nfact_air_quality AS (SELECT * FROM fact)" + ADHOC_SQL)
def q_adhoc_sql_report(spark, sf_dir):
    """Plain SQL over temp views of the fact and both dimensions."""
    from airindex.plans.views import register_views
    register_views(spark, sf_dir)
    return spark.sql(ADHOC_SQL)


@register("persist_daily_fact", O.with_fact("SELECT * FROM fact"))
def q_persist_daily_fact(spark, sf_dir):
    """The fact as a table partitioned by day: a first load of days 1-20, then an upsert of
    days 18 and later (recomputed), rewriting only the touched day partitions."""
    from airindex.operators.upsert import upsert_partitioned
    fact = daily_air_index(readings(spark, sf_dir))
    path = scratch_path(spark, "fact")
    upsert_partitioned(spark, path, fact.filter(_day() <= SPLIT_LAST_TARGET_DAY), FACT_KEYS,
                       "measure_date")
    upsert_partitioned(spark, path, fact.filter(_day() >= SPLIT_FIRST_UPDATE_DAY), FACT_KEYS,
                       "measure_date", FACT_UPDATE_COLS)
    return spark.read.parquet(path).select(*FACT_COLUMNS)


@register("incremental_refresh", O.with_readings(READING_SPLIT_SQL + ",\nmerged AS ("
                                               + merge_sql(READING_COLUMNS, READING_KEYS,
                                                           READING_UPDATE_COLS) + "),\n"
                                               + O.rolled_ctes("merged") + ",\n"
                                               + O.fact_ctes() + "\nSELECT * FROM fact"))
def q_incremental_refresh(spark, sf_dir):
    """Initial load of days 1-20, then late updates for days 18+: only the affected
    location-days are recomputed; the fact table must equal a full recomputation."""
    from airindex.plans.incremental import load_daily_fact, refresh_daily_fact
    r = readings(spark, sf_dir)
    readings_path, fact_path = scratch_path(spark, "readings"), scratch_path(spark, "fact")
    load_daily_fact(spark, readings_path, fact_path, reading_target(r))
    refresh_daily_fact(spark, readings_path, fact_path, reading_updates(r))
    return spark.read.parquet(fact_path).select(*FACT_COLUMNS)


@register("fact_table_by_name", O.with_fact("SELECT * FROM fact"))
def q_fact_table_by_name(spark, sf_dir):
    """The fact as a catalog table: created if absent with fixed columns and place, loaded with
    days 1-20, upserted with days 18 and later, read by name."""
    from uuid import uuid4

    from airindex.sinks.catalog_tables import create_table, upsert_table
    fact = daily_air_index(readings(spark, sf_dir))
    name = f"fact_{uuid4().hex}"
    create_table(spark, name, fact.schema, "measure_date", scratch_path(spark, "fact-table"))
    create_table(spark, name, fact.schema, "measure_date", scratch_path(spark, "not-used"))  # there already
    upsert_table(spark, name, fact.filter(_day() <= SPLIT_LAST_TARGET_DAY), FACT_KEYS, "measure_date")
    upsert_table(spark, name, fact.filter(_day() >= SPLIT_FIRST_UPDATE_DAY), FACT_KEYS,
                 "measure_date", FACT_UPDATE_COLS)
    return spark.table(name).select(*FACT_COLUMNS)


@register("bronze_day_range", O.with_readings(f"""
SELECT {O.READING_COLS} FROM readings WHERE measure_date BETWEEN
  (SELECT min(measure_date) FROM readings) + 3 AND (SELECT min(measure_date) FROM readings) + 9"""))
def q_bronze_day_range(spark, sf_dir):
    """Landing by day, then a range of days read with partition pruning (the range is the feature)."""
    import datetime as dt

    from airindex.sources.raw import read_landed_days
    locs = dim_location(spark, sf_dir)
    r = readings(spark, sf_dir)
    root = scratch_path(spark, "landing")
    write_raw_by_day(raw_payload(r, locs), root)
    first = r.agg(F.min("measure_date")).first()[0]
    raw = read_landed_days(spark, root, first + dt.timedelta(days=3), first + dt.timedelta(days=9))
    return flatten_measurements(raw, locs).select(*READING_COLUMNS)


@register("read_raw_partial_paths", _SCAN)
def q_read_raw_partial_paths(spark, sf_dir):
    """Several landing roots, one of them absent: the others are read in full."""
    locs = dim_location(spark, sf_dir)
    r = readings(spark, sf_dir)
    a, b = scratch_path(spark, "landing"), scratch_path(spark, "landing")
    write_raw_by_day(raw_payload(r.filter(_day() <= 15), locs), a)
    write_raw_by_day(raw_payload(r.filter(_day() > 15), locs), b)
    raw = read_raw(spark, [a, scratch_path(spark, "absent"), b], multi_line=False, recursive=True)
    return flatten_measurements(raw, locs).select(*READING_COLUMNS)


@register("conform_rejects", O.with_readings("""
SELECT lon, lat, count(*) AS readings, min(measured_at) AS first_at, max(measured_at) AS last_at
FROM readings WHERE location_id % 3 = 1 GROUP BY lon, lat"""))
def q_conform_rejects(spark, sf_dir):
    """Readings whose coordinates the location dimension lacks are kept and reported."""
    locs = dim_location(spark, sf_dir)
    raw = raw_payload(readings(spark, sf_dir), locs)
    return unmatched_locations(flatten_measurements(raw, locs.filter("location_id % 3 <> 1")))


@register("upsert_evolved_columns", O.with_readings("""
SELECT * EXCLUDE (nh3, aqi_label), CASE WHEN day(measure_date) <= 20 THEN aqi_label END AS aqi_label,
       CASE WHEN day(measure_date) >= 18 THEN nh3 END AS nh3,
       CASE WHEN day(measure_date) >= 18 THEN 'v2' END AS source
FROM readings"""))
def q_upsert_evolved_columns(spark, sf_dir):
    """A table without ``nh3`` upserted with readings that have it, a new column, and no label:
    stored columns stay, new ones are added."""
    from airindex.operators.upsert import upsert_partitioned
    r = readings(spark, sf_dir)
    path = scratch_path(spark, "evolving")
    upsert_partitioned(spark, path, r.filter(_day() <= SPLIT_LAST_TARGET_DAY).drop("nh3"),
                       READING_KEYS, "measure_date")
    late = r.filter(_day() >= SPLIT_FIRST_UPDATE_DAY).drop("aqi_label").withColumn("source", F.lit("v2"))
    upsert_partitioned(spark, path, late, READING_KEYS, "measure_date")
    return spark.read.option("mergeSchema", True).parquet(path).select(*READING_COLUMNS, "source")


@register("empty_inputs", """
SELECT 'absent path' AS case_name, 0::BIGINT AS n, true AS is_empty UNION ALL
SELECT 'events', count(*), count(*) = 0 FROM events UNION ALL
SELECT 'events of no day', 0, true""")
def q_empty_inputs(spark, sf_dir):
    """Guards: an absent landing path and an empty range flow through as empty frames; a count
    and an emptiness test of the whole table beside them."""
    absent = flatten_measurements(read_raw(spark, scratch_path(spark, "absent")))
    everything = load(spark, sf_dir, "events")
    nothing = daily_air_index(readings(spark, sf_dir, "1900-01-01", "1900-01-02"))
    cases = [("absent path", absent), ("events", everything), ("events of no day", nothing)]
    out = None
    for name, df in cases:
        row = df.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("case_name"), "n", (F.col("n") == 0).alias("is_empty"))
        out = row if out is None else out.unionByName(row)
    return out


@register("list_sizes", O.with_readings("""
SELECT location_id, measure_date, cast(count(*) AS int) AS n_measurements, true AS has_any,
       {valid} AS date_is_valid FROM readings GROUP BY location_id, measure_date""".format(
    valid="regexp_full_match(strftime(measure_date, '%Y-%m-%d'), '[0-9]{4}-[0-9]{2}-[0-9]{2}')")))
def q_list_sizes(spark, sf_dir):
    """Size of each payload's list, whether it has any, and the validity of its day as text."""
    locs = dim_location(spark, sf_dir)
    raw = raw_payload(readings(spark, sf_dir), locs)
    day = F.concat_ws("-", "yyyy", "mm", "dd")
    payload = raw.join(locs.select("location_id", "lon", "lat"),
                       (F.col("coord.lon") == F.col("lon")) & (F.col("coord.lat") == F.col("lat")))
    return payload.select("location_id", F.to_date(day).alias("measure_date"),
                          F.size("list").alias("n_measurements"), (F.size("list") > 0).alias("has_any"),
                          is_process_date(day).alias("date_is_valid"))
