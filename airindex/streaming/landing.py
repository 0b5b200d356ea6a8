"""Structured Streaming over the landing folder.

New landing files (one nested JSON object per location-day) are read as a file
stream with the explicit raw schema, flattened, de-duplicated within an event-time
watermark, and merged into the partitioned reading table per micro-batch with the
same keyed upsert as batch runs. The merge is idempotent, so a micro-batch that is
replayed after a failure (the checkpoint records what was committed) leaves the
table unchanged. ``trigger(availableNow=True)`` processes everything present and
stops, which is how a scheduled catch-up run uses it.

``sliding_mean`` is the event-time form of the rolling ozone mean: windows of
``window`` sliding by ``slide``, with a watermark so old state is dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airindex.functions.exact import mean_half_up
from airindex.operators.conform import flatten_measurements
from airindex.operators.upsert import latest_per_key, upsert_partitioned
from airindex.schemas import RAW, READING, READING_KEYS, READING_UPDATE_COLS

LANDED = "_landed"


def landing_stream(spark: SparkSession, root: str, locations: DataFrame,
                   max_files_per_trigger: int | None = None,
                   dedupe_watermark: str | None = None, multi_line: bool = True) -> DataFrame:
    """Streaming readings from landing files under ``root`` (any depth of folders): a payload
    per file, or per line without ``multi_line``.

    The keyed merge in the sink already makes repeated readings harmless, so no
    watermark is needed. ``dedupe_watermark`` adds ``dropDuplicatesWithinWatermark``
    for live feeds; rows older than the watermark are then dropped as late, so do
    not use it for backfills that land days out of order.
    """
    reader = (spark.readStream.schema(RAW).option("multiLine", multi_line)
              .option("recursiveFileLookup", True).option("pathGlobFilter", "*.json"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # Which file a reading came from: newer files win when a batch has two versions.
    landed = F.struct(F.col("_metadata.file_modification_time").alias("mtime"),
                      F.col("_metadata.file_path").alias("path"))
    raw = reader.json(root).select("coord", "list", landed.alias(LANDED))
    readings = flatten_measurements(raw, locations, carry=(LANDED,))
    if dedupe_watermark:
        readings = (readings.withWatermark("measured_at", dedupe_watermark)
                    .dropDuplicatesWithinWatermark(list(READING_KEYS)))
    return readings


def upsert_sink(table_path: str, keys: Sequence[str] = READING_KEYS,
                update_cols: Sequence[str] = READING_UPDATE_COLS,
                partition_col: str = "measure_date",
                rejects_path: str | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch function: merge each micro-batch into the table at ``table_path``.

    Readings without a complete key (no known location, no time) are written below
    ``rejects_path``, one folder per batch, so that a replayed batch replaces its own; without
    a path a batch that has any fails.
    Across micro-batches the later batch wins (batches follow file arrival).
    """
    columns = [f.name for f in READING.fields]

    def write(batch: DataFrame, batch_id: int) -> None:
        if LANDED in batch.columns:
            # Latest landing file wins within the micro-batch (map-side reduced).
            batch = latest_per_key(batch, list(keys), LANDED)
        rejects = upsert_partitioned(batch.sparkSession, table_path, batch.select(*columns),
                                     keys, partition_col, update_cols, schema=READING)
        if rejects.isEmpty():
            return
        if rejects_path is None:
            raise ValueError(f"{rejects.count()} readings without a key, and no rejects_path")
        rejects.write.mode("overwrite").parquet(f"{rejects_path}/batch={batch_id}")
    return write


def run_available_now(stream: DataFrame, sink: Callable[[DataFrame, int], None],
                      checkpoint_location: str, name: str | None = None) -> None:
    """Process every file present now in micro-batches, then stop."""
    writer = (stream.writeStream.foreachBatch(sink)
              .option("checkpointLocation", checkpoint_location)
              .trigger(availableNow=True))
    if name:
        writer = writer.queryName(name)
    writer.start().awaitTermination()


def start_continuous(stream: DataFrame, sink: Callable[[DataFrame, int], None],
                     checkpoint_location: str, every: str = "5 minutes",
                     name: str | None = None):
    """Run the same pipeline as a live feed: a micro-batch every ``every``.

    Returns the running ``StreamingQuery`` (stop it with ``.stop()``).
    """
    writer = (stream.writeStream.foreachBatch(sink)
              .option("checkpointLocation", checkpoint_location)
              .trigger(processingTime=every))
    if name:
        writer = writer.queryName(name)
    return writer.start()


def sliding_mean(readings: DataFrame, value: str = "o3", window: str = "8 hours",
                 slide: str = "1 hour", ts: str = "measured_at",
                 by: Sequence[str] = ("location_id",), watermark: str | None = None,
                 digits: int = 6) -> DataFrame:
    """Event-time sliding-window mean and counts of ``value`` per key (batch or stream)."""
    src = readings.withWatermark(ts, watermark) if watermark else readings
    g = src.groupBy(*by, F.window(ts, window, slide).alias("w"))
    return g.agg(mean_half_up(value, digits).alias(f"mean_{value}"),
                 F.count(value).alias(f"n_{value}"),
                 F.count(F.lit(1)).alias("n_readings")).select(
        *by, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        f"mean_{value}", f"n_{value}", "n_readings")
