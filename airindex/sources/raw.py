"""Landing files: read raw JSON with an explicit schema; plan which source-days to land."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airindex.functions.dates import day_end_epoch, slug
from airindex.schemas import RAW

_LOG = logging.getLogger(__name__)


def day_glob(root: str, day: dt.date | str) -> str:
    """Glob of one day's landing files for every location: ``root/*/yyyy/mm/dd*.json``."""
    day = dt.date.fromisoformat(day) if isinstance(day, str) else day
    return f"{root.rstrip('/')}/*/{day:%Y}/{day:%m}/{day:%d}*.json"


def range_glob(root: str, start: dt.date | str, end: dt.date | str) -> str:
    """One glob for the landing files of every location on ``[start, end]``.

    Days are alternatives (``{yyyy/mm/dd,...}``; a fully covered month becomes
    ``yyyy/mm/*``), so days without files are simply absent; only a range with no
    file at all is a missing path.
    """
    start = dt.date.fromisoformat(start) if isinstance(start, str) else start
    end = dt.date.fromisoformat(end) if isinstance(end, str) else end
    if end < start:
        raise ValueError(f"end {end} is before start {start}")
    alts, day = [], start
    while day <= end:
        first = day.replace(day=1)
        nxt = (first + dt.timedelta(days=32)).replace(day=1)
        last = nxt - dt.timedelta(days=1)
        if day == first and last <= end:
            alts.append(f"{day:%Y}/{day:%m}/*")
            day = nxt
        else:
            alts.append(f"{day:%Y}/{day:%m}/{day:%d}")
            day += dt.timedelta(days=1)
    return f"{root.rstrip('/')}/*/{{{','.join(alts)}}}*.json"


def present_paths(spark: SparkSession, paths: Sequence[str]) -> tuple[list[str], list[str]]:
    """(paths or globs that match something, the others), asked of each path's own file system."""
    conf = spark._jsc.hadoopConfiguration()
    there, missing = [], []
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        found = at.getFileSystem(conf).globStatus(at)
        (there if found is not None and len(found) else missing).append(path)
    return there, missing


def read_raw(spark: SparkSession, paths: str | Sequence[str], multi_line: bool = True,
             schema=RAW, recursive: bool = False, missing: list[str] | None = None) -> DataFrame:
    """Raw payload with the explicit schema; paths that do not exist are left out.

    Only if none exists the frame is empty. The absent paths are appended to
    ``missing`` and logged as a warning, so that a caller can report them.

    Passing the schema skips inference, so an empty ``list`` or an integral value
    never changes column types. ``multi_line`` reads each file as one document.
    ``recursive`` reads every ``*.json`` below the given folders (one listing pass,
    much cheaper than expanding a multi-level glob).
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    there, absent = present_paths(spark, paths)
    if absent:
        _LOG.warning("%d of %d landing paths do not exist: %s", len(absent), len(paths), absent[:5])
    if missing is not None:
        missing += absent
    if not there:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("multiLine", multi_line)
    if recursive:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    return reader.json(there).select(*[f.name for f in schema.fields])


# Landing by day: one folder per day, the objects of many locations in line-delimited files.
DAY = "landing_day"


def read_landed_days(spark: SparkSession, root: str, start: dt.date | str, end: dt.date | str,
                     schema=RAW) -> DataFrame:
    """Payload rows of the days ``[start, end]`` from ``write_raw_by_day``'s layout.

    The day is a partition column, so only the folders of the range are listed and read.
    """
    start = dt.date.fromisoformat(start) if isinstance(start, str) else start
    end = dt.date.fromisoformat(end) if isinstance(end, str) else end
    if present_paths(spark, [root])[1]:
        return spark.createDataFrame([], schema)
    table = spark.read.schema(T.StructType([*schema.fields, T.StructField(DAY, T.DateType())]))
    return (table.json(root).filter(F.col(DAY).between(F.lit(start), F.lit(end)))
            .select(*[f.name for f in schema.fields]))


def write_raw_by_day(payload: DataFrame, root: str) -> None:
    """Land payload rows (with ``yyyy``, ``mm``, ``dd``) in one folder per day, a row per line.

    Files hold many locations; adaptive execution splits a large day over several files.
    Rewriting a day replaces that day alone.
    """
    day = F.make_date(F.col("yyyy").cast("int"), F.col("mm").cast("int"), F.col("dd").cast("int"))
    (payload.withColumn(DAY, day).drop("city_slug", "yyyy", "mm", "dd").hint("rebalance", DAY)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).json(root))


def append_raw(payload: DataFrame, root: str) -> None:
    """Land payload rows as new line-delimited files below ``root``; earlier files stay."""
    payload.select(*[f.name for f in RAW.fields]).write.mode("append").json(root)


def write_raw(payload: DataFrame, root: str) -> None:
    """Land payload rows under ``root`` in ``city_slug=.../yyyy=.../mm=.../dd=...`` folders,
    one object per file (one payload row per location-day).

    Spark names partition folders ``key=value``; read them back with
    ``read_raw(spark, root, recursive=True)``. ``day_glob`` / ``range_glob`` match
    the plain ``city/yyyy/mm/dd.json`` layout of files landed by other writers.
    """
    (payload.hint("rebalance", "city_slug", "yyyy", "mm", "dd")
     .write.mode("overwrite").partitionBy("city_slug", "yyyy", "mm", "dd").json(root))


def request_plan(locations: DataFrame, start: dt.date | str | None = None,
                 end: dt.date | str | None = None, dates: DataFrame | None = None) -> DataFrame:
    """One row per (location, UTC day) to fetch: epoch window and landing key.

    The day range is either ``[start, end]`` or, when ``dates`` (one ``measure_date``
    column) is given, the span of those dates. Each location row explodes its own
    day sequence, so the work is spread over the location rows.
    """
    if dates is not None:
        # A scalar subquery: the span is one value, not a joined table.
        span = dates.agg(F.struct(F.min("measure_date").alias("first"), F.max("measure_date").alias("last")).alias("span")).scalar()
        base = locations
        day = F.explode(F.sequence(span["first"], span["last"]))
    else:
        s = dt.date.fromisoformat(start) if isinstance(start, str) else start
        e = dt.date.fromisoformat(end) if isinstance(end, str) else end
        base = locations
        day = F.explode(F.sequence(F.lit(s), F.lit(e)))
    days = base.select("location_id", "city_name", "lon", "lat", day.alias("request_date"))
    start_epoch = F.unix_timestamp(F.col("request_date").cast("timestamp"))
    city = slug("city_name")
    return days.select(
        "location_id", "request_date", "lon", "lat",
        start_epoch.alias("start_epoch"),
        day_end_epoch(start_epoch).alias("end_epoch"),
        city.alias("city_slug"),
        F.format_string("%s/%s/%s/%s.json", city, F.date_format("request_date", "yyyy"),
                        F.date_format("request_date", "MM"),
                        F.date_format("request_date", "dd")).alias("object_key"))
