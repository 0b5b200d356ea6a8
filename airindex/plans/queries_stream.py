"""Streaming queries: landing files -> micro-batch upsert -> reading table."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from airindex.operators.conform import raw_payload
from airindex.plans import oracle as O
from airindex.plans.catalog import register
from airindex.schemas import POLLUTANTS, READING, READING_KEYS
from airindex.session import remove_path, scratch_path
from airindex.sources.raw import append_raw, write_raw_by_day
from airindex.sources.tables import dim_location, reading_days, readings
from airindex.streaming.landing import landing_stream, run_available_now, sliding_mean, upsert_sink
from airindex.streaming.rolling import buckets_for, landed_stream, rolling_rows_stream, run_counting_late

READING_COLUMNS = [f.name for f in READING.fields]
FILES_PER_BATCH = 8


@register("stream_landing_upsert", O.with_readings(f"SELECT {O.READING_COLS} FROM readings"))
def q_stream_landing_upsert(spark, sf_dir):
    """Land readings as JSON, stream them (several micro-batches) into a partitioned
    table with the keyed upsert, and read the table back."""
    locs = dim_location(spark, sf_dir)
    landing = scratch_path(spark, "landing")
    write_raw_by_day(raw_payload(readings(spark, sf_dir), locs), landing)
    table = scratch_path(spark, "silver")
    stream = landing_stream(spark, landing, locs, max_files_per_trigger=FILES_PER_BATCH, multi_line=False)
    run_available_now(stream, upsert_sink(table), scratch_path(spark, "stream-checkpoint"))
    return spark.read.schema(READING).parquet(table).select(*READING_COLUMNS)


# A live feed in four arrivals: ten days each, out of order at the seams (every fifth hour of the days
# around a seam comes with the next arrival), and last some readings far behind the watermark.
DELAY = "47 hours 30 minutes"
SEAMS = (10, 20)
TURN = "arrival"
LATE = "location_id % 10 = 3 AND hour(measured_at) = 5 AND day(measure_date) BETWEEN 2 AND 6"
LIVE_SQL = f""",
kept AS (SELECT * FROM readings WHERE NOT ({LATE})),
mark AS (SELECT max(measured_at) - INTERVAL 47 HOUR - INTERVAL 30 MINUTE AS until FROM kept)"""


def arrivals(spark, sf_dir, path):
    """The readings of each arrival, in order. They are made from the events once and stored by arrival below ``path``."""
    r = readings(spark, sf_dir)
    day, behind = F.dayofmonth("measure_date"), F.hour("measured_at") % 5 == 0
    month = (F.year("measure_date") * 12 + F.month("measure_date")).cast("int")
    # Days since the first month's start keep the arrivals in order over month ends.
    first = reading_days(spark, sf_dir).select(F.min("measure_date")).scalar()
    at = (month - (F.year(first) * 12 + F.month(first))) * 31 + day
    late = F.expr(LATE)
    turn = F.lit(0)
    for seam in SEAMS:
        turn = turn + ((at > seam) | ((at == seam) & behind)).cast("int")
    turn = F.when(late, len(SEAMS) + 1).otherwise(turn)
    # Labels and date parts are no part of a payload.
    landed = [READING[c] for c in (*READING_KEYS, "lon", "lat", "aqi_level", *POLLUTANTS, "measure_date")]
    r.select(*[f.name for f in landed], turn.alias(TURN)).write.partitionBy(TURN).parquet(path)
    stored = spark.read.schema(T.StructType([*landed, T.StructField(TURN, T.IntegerType())])).parquet(path)
    return [stored.filter(F.col(TURN) == k).drop(TURN) for k in range(len(SEAMS) + 2)]


def run_live(spark, sf_dir, operator):
    """Land each arrival and catch up with it; (the table's path, what each run did)."""
    root, table, checkpoint, parts, places = (
        scratch_path(spark, x) for x in ("live", "live-table", "live-checkpoint", "live-arrivals", "live-locations"))
    # Stored once: every arrival and every micro-batch joins the locations.
    locs = dim_location(spark, sf_dir)
    locs.write.parquet(places)
    locs = spark.read.schema(locs.schema).parquet(places)
    runs = []
    for part in arrivals(spark, sf_dir, parts):
        append_raw(raw_payload(part, locs), root)
        runs.append(run_counting_late(operator(landed_stream(spark, root, locs), locs), table, checkpoint))
    for path in (parts, places):
        remove_path(spark, path)
    return table, runs


def _rolling(stream, locs):
    return rolling_rows_stream(stream, DELAY, buckets=buckets_for(locs.count()))


@register("stream_rolling_rows", O.with_readings(LIVE_SQL + ",\n" + O.rolled_ctes("kept") + """
SELECT location_id, measured_at, o3, rolling_o3, count_o3 FROM rolled WHERE measured_at <= (SELECT until FROM mark)"""))
def q_stream_rolling_rows(spark, sf_dir):
    """8-row means with state, over readings that arrive out of order in several runs: all that the
    watermark has passed, equal to the batch result without the late ones."""
    return spark.read.parquet(run_live(spark, sf_dir, _rolling)[0])


@register("stream_late_rows", O.with_readings(f"""
SELECT count(*) FILTER (NOT ({LATE})) AS in_time, count(*) FILTER ({LATE}) AS late FROM readings"""))
def q_stream_late_rows(spark, sf_dir):
    """How many readings of the live feed came in time and too late, by the engine's own count."""
    _, runs = run_live(spark, sf_dir, _rolling)
    late = sum(x.late for x in runs)
    landed = readings(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))
    return landed.select((F.col("n") - late).alias("in_time"), F.lit(late).cast("long").alias("late"))


@register("stream_sliding_append", O.with_readings(LIVE_SQL + f""",
w AS (SELECT location_id, measured_at - to_hours(k) AS window_start, measured_at - to_hours(k) + INTERVAL 8 HOUR AS window_end, o3
      FROM kept, range(8) AS r(k))
SELECT location_id, window_start, window_end, {O.mean_sql('o3', 6)} AS mean_o3, count(o3) AS n_o3, count(*) AS n_readings
FROM w WHERE window_end <= (SELECT until FROM mark) GROUP BY 1, 2, 3"""))
def q_stream_sliding_append(spark, sf_dir):
    """8-hour windows sliding by an hour, in append mode behind a watermark: the closed windows."""
    table, _ = run_live(spark, sf_dir, lambda stream, _: sliding_mean(stream, watermark=DELAY))
    return spark.read.parquet(table)
