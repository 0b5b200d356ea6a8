"""Command-line jobs: landing -> reading table -> daily fact table -> CSV extract.

Each job covers a date range in one Spark application (a backfill is one run,
not one run per day) and upserts by key, so re-running a range is idempotent.

    python -m airindex.plans.jobs conform --landing L --locations LOC --readings R \\
        --start 2024-01-01 --end 2024-01-30
    python -m airindex.plans.jobs fact --readings R --fact F --start ... --end ...
    python -m airindex.plans.jobs export --fact F --locations LOC --out CSV_DIR

Tables are parquet folders partitioned by ``measure_date``; ``--locations`` is a
parquet table (location_id, city_name, lon, lat).
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession

from airindex.operators.conform import flatten_measurements
from airindex.operators.star import dim_date_spanning, star_report
from airindex.operators.upsert import upsert_partitioned
from airindex.plans.daily import daily_air_index, day_range_buffer
from airindex.schemas import (FACT_KEYS, FACT_UPDATE_COLS, READING, READING_KEYS,
                              READING_UPDATE_COLS)
from airindex.session import build_session
from airindex.sinks.files import write_csv
from airindex.sources.raw import range_glob, read_raw

READING_COLUMNS = [f.name for f in READING.fields]


def run_conform(spark: SparkSession, landing: str, locations: str, readings: str,
                start: dt.date, end: dt.date) -> int:
    """Landing JSON of [start, end] -> upsert into the reading table.

    Every reading of the landed files is merged, also one whose UTC day is outside the range
    (a file may straddle midnight). Returns the number of rejects: readings without a known
    location or without a time.
    """
    raw = read_raw(spark, range_glob(landing, start, end))
    locs = spark.read.parquet(locations)
    flat = flatten_measurements(raw, locs)
    rejects = upsert_partitioned(spark, readings, flat.select(*READING_COLUMNS), READING_KEYS,
                                 "measure_date", READING_UPDATE_COLS, schema=READING)
    return rejects.count()


def run_fact(spark: SparkSession, readings: str, fact: str, start: dt.date,
             end: dt.date) -> None:
    """Reading table -> daily fact of [start, end] (reads start-1 for the ozone halo)."""
    src = day_range_buffer(spark.read.schema(READING).parquet(readings), start, end)
    out = daily_air_index(src, start, end)
    upsert_partitioned(spark, fact, out, FACT_KEYS, "measure_date", FACT_UPDATE_COLS)


def run_export(spark: SparkSession, fact: str, locations: str, out: str,
               single_file: bool = False) -> None:
    """Fact table -> star report -> CSV with header (overwrite)."""
    f = spark.read.parquet(fact)
    report = star_report(f, dim_date_spanning(f), spark.read.parquet(locations))
    write_csv(report, out, single_file=single_file)


def _date(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="airindex.plans.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    c = sub.add_parser("conform")
    c.add_argument("--landing", required=True)
    c.add_argument("--locations", required=True)
    c.add_argument("--readings", required=True)
    f = sub.add_parser("fact")
    f.add_argument("--readings", required=True)
    f.add_argument("--fact", required=True)
    for q in (c, f):
        q.add_argument("--start", required=True, type=_date)
        q.add_argument("--end", required=True, type=_date)
    e = sub.add_parser("export")
    e.add_argument("--fact", required=True)
    e.add_argument("--locations", required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--single-file", action="store_true")
    args = p.parse_args(argv)
    spark = spark or build_session(app_name=f"airindex-{args.job}")
    if args.job == "conform":
        rejects = run_conform(spark, args.landing, args.locations, args.readings,
                              args.start, args.end)
        if rejects:
            print(f"{rejects} readings without a known location or a time were rejected", file=sys.stderr)
    elif args.job == "fact":
        run_fact(spark, args.readings, args.fact, args.start, args.end)
    else:
        run_export(spark, args.fact, args.locations, args.out, args.single_file)
    return 0


if __name__ == "__main__":
    sys.exit(main())
