"""Damaged payloads, incremental landing, histories, gaps and SQL functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from airindex.functions.labels import STATUS_VALID
from airindex.operators.conform import flatten_measurements, raw_payload
from airindex.operators.upsert import upsert_partitioned
from airindex.operators.validity import as_of_join, gap_ranges, state_changes, validity
from airindex.plans import oracle as O
from airindex.plans.catalog import register
from airindex.plans.daily import daily_air_index
from airindex.schemas import READING, READING_KEYS, READING_UPDATE_COLS
from airindex.session import scratch_path
from airindex.sources.checked import REJECTED, read_good
from airindex.sources.ledger import process_new
from airindex.sources.raw import DAY, write_raw_by_day
from airindex.sources.tables import dim_location, load, location_of, readings

READING_COLUMNS = [f.name for f in READING.fields]
# How the landed documents are damaged: by (location + day of month) modulo 7.
DAMAGE = "(location_id + day(measure_date)) % 7"


def _payload(spark, sf_dir):
    """Payload rows with their location and day."""
    locs = dim_location(spark, sf_dir)
    raw = raw_payload(readings(spark, sf_dir), locs)
    known = locs.select("location_id", F.col("lon").alias("_x"), F.col("lat").alias("_y"))
    day = F.make_date(F.col("yyyy").cast("int"), F.col("mm").cast("int"), F.col("dd").cast("int"))
    return raw.join(known, (F.col("coord.lon") == F.col("_x")) & (F.col("coord.lat") == F.col("_y"))).withColumn("measure_date", day), locs


def land_damaged(spark, sf_dir, root):
    """Every payload as a line of JSON; some cut short, without coordinates, without a list, or with text for a time."""
    payload, locs = _payload(spark, sf_dir)
    text = F.to_json(F.struct("coord", "list"))
    kind = F.expr(DAMAGE)
    damaged = (F.when(kind == 0, F.substr(text, F.lit(1), F.length(text) - 9))
               .when(kind == 1, F.to_json(F.struct("list")))
               .when(kind == 2, F.to_json(F.struct("coord")))
               .when(kind == 3, F.regexp_replace(text, '"dt":([0-9]+)', '"dt":"at $1"')).otherwise(text))
    (payload.select(damaged.alias("value"), F.col("measure_date").alias(DAY)).hint("rebalance", DAY)
     .write.partitionBy(DAY).text(root))
    return locs


@register("damaged_payloads_good", O.with_readings(f"SELECT {O.READING_COLS} FROM readings WHERE {DAMAGE} > 3"))
def q_damaged_payloads_good(spark, sf_dir):
    """A landing with damaged documents: the readings of the others."""
    root = scratch_path(spark, "damaged")
    locs = land_damaged(spark, sf_dir, root)
    good = read_good(spark, root, scratch_path(spark, "quarantine"), pattern="*.txt")
    return flatten_measurements(good, locs).select(*READING_COLUMNS)


@register("damaged_payloads_rejects", O.with_readings(f"""
SELECT DISTINCT measure_date AS landing_day, CASE {DAMAGE} WHEN 1 THEN 'no_coordinates' WHEN 2 THEN 'no_measurements' ELSE 'malformed' END AS reason,
       CASE WHEN {DAMAGE} <> 1 THEN lon END AS lon, CASE WHEN {DAMAGE} = 1 THEN location_id END AS unnamed
FROM readings WHERE {DAMAGE} <= 3""").replace("SELECT DISTINCT measure_date AS landing_day", "SELECT landing_day, reason, lon FROM (SELECT DISTINCT measure_date AS landing_day")
          + ")")
def q_damaged_payloads_rejects(spark, sf_dir):
    """One row per damaged document in the quarantine table, also after the landing is read twice."""
    root, table = scratch_path(spark, "damaged"), scratch_path(spark, "quarantine")
    land_damaged(spark, sf_dir, root)
    for _ in range(2):
        read_good(spark, root, table, pattern="*.txt")
    rejects = spark.read.schema(REJECTED).parquet(table)
    lon = F.regexp_extract("payload", r'"lon":([0-9.]+)', 1)
    return rejects.select(F.to_date(F.regexp_extract("path", f"{DAY}=([0-9-]+)", 1)).alias("landing_day"), "reason",
                          F.when(lon != "", lon.cast("double")).alias("lon"))


def run_ledger(spark, sf_dir):
    """Three runs: days up to 15; the others and a corrected first day; nothing new. (table, rows read by run)"""
    locs = dim_location(spark, sf_dir)
    r = readings(spark, sf_dir)
    day = F.dayofmonth("measure_date")
    root, ledger, table = (scratch_path(spark, x) for x in ("landing", "ledger", "silver"))
    seen = []

    def process(payload):
        flat = flatten_measurements(payload, locs).select(*READING_COLUMNS)
        upsert_partitioned(spark, table, flat, READING_KEYS, "measure_date", READING_UPDATE_COLS, schema=READING)
        seen[-1] += payload.count()

    corrected = r.filter(day == 1).withColumn("pm2_5", F.col("pm2_5") + 1)
    for landed in (r.filter(day <= 15), r.filter(day > 15).unionByName(corrected), None):
        if landed is not None:
            write_raw_by_day(raw_payload(landed, locs), root)
        seen.append(0)
        process_new(spark, root, ledger, process)
    return table, seen


@register("ledger_runs", O.with_readings("""
, days AS (SELECT DISTINCT location_id, measure_date FROM readings)
SELECT 1 AS run, count(*) FILTER (day(measure_date) <= 15) AS payloads FROM days
UNION ALL SELECT 2, count(*) FILTER (day(measure_date) > 15 OR day(measure_date) = 1) FROM days
UNION ALL SELECT 3, 0"""))
def q_ledger_runs(spark, sf_dir):
    """Payloads read per run: the second reads new and changed files only, the third none."""
    _, seen = run_ledger(spark, sf_dir)
    return spark.range(len(seen)).select((F.col("id") + 1).cast("int").alias("run"),
                                         F.get(F.array(*[F.lit(n).cast("long") for n in seen]), F.col("id").cast("int")).alias("payloads"))


@register("ledger_table", O.with_readings(f"""
SELECT {O.READING_COLS.replace('pm2_5', 'CASE WHEN day(measure_date) = 1 THEN pm2_5 + 1 ELSE pm2_5 END AS pm2_5')} FROM readings"""))
def q_ledger_table(spark, sf_dir):
    """The reading table after the three runs: every day once, the first day corrected."""
    return spark.read.schema(READING).parquet(run_ledger(spark, sf_dir)[0]).select(*READING_COLUMNS)


LEVELS_SQL = """,
moves AS (SELECT location_id, measured_at, aqi_level FROM (
  SELECT *, lag(aqi_level) OVER w AS before, row_number() OVER w AS k FROM readings
  WINDOW w AS (PARTITION BY location_id ORDER BY measured_at)) WHERE k = 1 OR before IS DISTINCT FROM aqi_level)"""


def level_changes(spark, sf_dir):
    return state_changes(readings(spark, sf_dir), ["location_id"], "measured_at", ["aqi_level"])


@register("validity_intervals", O.with_readings(LEVELS_SQL + """
SELECT location_id, aqi_level, measured_at AS valid_from,
       lead(measured_at) OVER (PARTITION BY location_id ORDER BY measured_at) AS valid_to FROM moves"""))
def q_validity_intervals(spark, sf_dir):
    """From when until when each location had which level."""
    return validity(level_changes(spark, sf_dir), ["location_id"], "measured_at")


@register("as_of_events", O.with_readings(LEVELS_SQL + """,
asked AS (SELECT event_id, cast(user_id // 20 AS int) AS location_id, ts - INTERVAL 90 MINUTE AS instant FROM events)
SELECT a.event_id, a.location_id, a.instant, m.aqi_level AS level_then, m.measured_at AS since
FROM asked a ASOF LEFT JOIN moves m ON a.location_id = m.location_id AND a.instant >= m.measured_at"""))
def q_as_of_events(spark, sf_dir):
    """Every event with its location's level as it was 90 minutes before: an instant per row."""
    asked = load(spark, sf_dir, "events").select(
        "event_id", location_of().alias("location_id"), (F.col("ts").cast("timestamp") - F.expr("INTERVAL 90 MINUTE")).alias("instant"))
    found = as_of_join(asked, level_changes(spark, sf_dir).withColumnRenamed("measured_at", "since"), ["location_id"], "instant", "since")
    return found.select("event_id", "location_id", F.col("instant").cast("timestamp_ntz").alias("instant"),
                        F.col("aqi_level").alias("level_then"), F.col("since").cast("timestamp_ntz").alias("since"))


@register("coverage_gap_hours", O.with_readings(""",
span AS (SELECT min(measure_date)::TIMESTAMP AS s, max(measure_date)::TIMESTAMP + INTERVAL 23 HOUR AS e FROM readings),
hours AS (SELECT location_id, g.h FROM dim_location, span, generate_series(span.s, span.e, INTERVAL 1 HOUR) AS g(h)),
absent AS (SELECT * FROM hours x WHERE NOT EXISTS (SELECT 1 FROM readings r WHERE r.location_id = x.location_id AND r.measured_at = x.h)),
islands AS (SELECT *, h - to_hours(row_number() OVER (PARTITION BY location_id ORDER BY h)) AS island FROM absent)
SELECT location_id, min(h) AS gap_from, max(h) AS gap_to, count(*) AS missing FROM islands GROUP BY location_id, island"""))
def q_coverage_gap_hours(spark, sf_dir):
    """Ranges of hours without a reading, per location, over the days of all readings."""
    r = readings(spark, sf_dir)
    span = r.agg(F.struct(F.min("measure_date").alias("s"), F.max("measure_date").alias("e")).alias("span")).scalar()
    return gap_ranges(r, ["location_id"], "measured_at", "1 hour",
                      (span["s"].cast("timestamp"), span["e"].cast("timestamp") + F.expr("INTERVAL 23 HOUR")), dim_location(spark, sf_dir))


@register("rerun_ranges", O.with_fact(f""",
span AS (SELECT min(measure_date) AS s, max(measure_date) AS e FROM readings),
days AS (SELECT location_id, cast(g.d AS date) AS d FROM dim_location, span, generate_series(span.s, span.e, INTERVAL 1 DAY) AS g(d)),
absent AS (SELECT * FROM days x WHERE NOT EXISTS (SELECT 1 FROM fact f WHERE f.location_id = x.location_id AND f.measure_date = x.d
           AND f.data_quality_status = {O.q(STATUS_VALID)})),
islands AS (SELECT *, d - cast(row_number() OVER (PARTITION BY location_id ORDER BY d) AS int) AS island FROM absent)
SELECT location_id, min(d) AS gap_from, max(d) AS gap_to, count(*) AS missing FROM islands GROUP BY location_id, island"""))
def q_rerun_ranges(spark, sf_dir):
    """Ranges of days to land again, per location: days without a fact or with one that failed the quality gate."""
    r = readings(spark, sf_dir)
    span = r.agg(F.struct(F.min("measure_date").alias("s"), F.max("measure_date").alias("e")).alias("span")).scalar()
    valid = daily_air_index(r).filter(F.col("data_quality_status") == STATUS_VALID)
    at = valid.select("location_id", F.col("measure_date").cast("timestamp").alias("day"))
    out = gap_ranges(at, ["location_id"], "day", "1 day", (span["s"].cast("timestamp"), span["e"].cast("timestamp")), dim_location(spark, sf_dir))
    return out.withColumns({c: F.to_date(c) for c in ("gap_from", "gap_to")})


FUNCTIONS_SQL = """
SELECT f.location_id, f.measure_date, index_pm25(f.avg_pm2_5) AS pm25, index_ozone(f.max_1h_o3, f.max_8h_o3) AS ozone,
       health_name(f.vn_aqi) AS health, hazardous(f.vn_aqi) AS is_hazardous, day_status(f.record_count, f.avg_pm2_5, f.avg_pm10) AS status,
       dominant_of(index_pm25(f.avg_pm2_5), index_pm10(f.avg_pm10), index_co(f.max_1h_co), index_no2(f.max_1h_no2),
                   index_so2(f.max_1h_so2), index_ozone(f.max_1h_o3, f.max_8h_o3)) AS dominant, level_name(f.max_aqi) AS worst_level
FROM fact_air_quality f"""


@register("sql_scalar_functions", O.with_fact(f"""
SELECT location_id, measure_date, aqi_pm25 AS pm25, aqi_o3 AS ozone, {O.health_label_sql('vn_aqi')} AS health,
       {O.hazardous_sql('vn_aqi')} AS is_hazardous, {O.status_sql()} AS status,
       {O.dominant_sql('0')} AS dominant, {O.level_label_sql('max_aqi')} AS worst_level FROM fact_all"""))
def q_sql_scalar_functions(spark, sf_dir):
    """An ad-hoc statement that calls the index and label functions by name."""
    from airindex.plans.sql_functions import register_functions, register_tables
    register_functions(spark)
    register_tables(spark, sf_dir)
    return spark.sql(FUNCTIONS_SQL)


@register("sql_table_functions", O.with_rolled(f""",
{O.fact_ctes()},
span AS (SELECT min(measure_date) AS s, max(measure_date) AS e FROM readings),
worst AS (SELECT * FROM (SELECT location_id, measure_date, vn_aqi, row_number() OVER (PARTITION BY location_id ORDER BY vn_aqi DESC NULLS LAST, measure_date) AS place
                         FROM fact) WHERE place <= 3)
SELECT w.location_id, w.measure_date, w.vn_aqi, r.measured_at, r.rolling_o3 AS mean_8, r.count_o3 AS values_8
FROM worst w JOIN rolled r ON r.location_id = w.location_id AND r.measure_date = w.measure_date"""))
def q_sql_table_functions(spark, sf_dir):
    """Table functions in one statement: each location's three worst days with their rolling ozone means."""
    from airindex.plans.sql_functions import register_tables
    register_tables(spark, sf_dir)
    return spark.sql("""SELECT w.location_id, w.measure_date, w.vn_aqi, r.measured_at, r.mean_8, r.values_8
        FROM worst_days(3) w JOIN rolling_ozone(DATE '1970-01-01', DATE '2100-01-01') r
          ON r.location_id = w.location_id AND to_date(r.measured_at) = w.measure_date""")


