"""Live forms of the rolling means: event-time windows in append mode, and a row window with state.

``rolling_rows_stream`` is the streaming form of ``operators.rolling.rolling_rows``: the mean over the
last rows of a location, in event time although rows arrive out of order. Its state per location is the
rows that the watermark has not passed yet and the last rows that it has; a row is emitted when the
watermark passes it, so what is emitted is final and equals the batch result over the rows that were
not late. A few locations share a state row (a bucket of the key's hash): the cost of handing one group to
Python and back is many times that of a location's rows. Rows behind the watermark are dropped by the engine, which counts them; ``run_counting_late``
returns that count.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from airindex.functions.exact import SCALE
from airindex.streaming.landing import LANDED, landing_stream

# Task functions travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DAY_US = 86_400_000_000
AT, VALUE = np.dtype("<i8"), np.dtype("<f8")
# A bucket's keys, how many pending and kept rows each has, and these rows key by key, as the bytes of numpy arrays.
STATE = "keys array<{kind}>, n_pending binary, n_kept binary, pending_at binary, pending binary, kept_at binary, kept binary"
STATE_TYPES = (AT, AT, AT, VALUE, AT, VALUE)
KEYS_PER_BUCKET = 32
BUCKETS = 1024


@dataclass(frozen=True)
class Ran:
    """What a run did: rows read, rows dropped as late, micro-batches."""

    rows: int
    late: int
    batches: int


def landed_stream(spark: SparkSession, root: str, locations: DataFrame, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming readings from line-delimited payload files below ``root`` (``append_raw``, ``write_raw_by_day``)."""
    return landing_stream(spark, root, locations, max_files_per_trigger, multi_line=False).drop(LANDED)


def passed(pending_at: np.ndarray, pending: np.ndarray, kept_at: np.ndarray, kept: np.ndarray, until: int, rows: int):
    """What a watermark at ``until`` (microseconds) settles: (times, values, means, counts) of the pending rows
    up to it, in order, and the new state. A mean is over the row and the ``rows - 1`` before it that lie on
    its day or the day before; NaN is a missing value."""
    order = np.argsort(pending_at, kind="stable")
    pending_at, pending = pending_at[order], pending[order]
    n = int(np.searchsorted(pending_at, until, "right"))
    at, value = np.concatenate([kept_at, pending_at[:n]]), np.concatenate([kept, pending[:n]])
    first = np.maximum(np.arange(len(at)) - (rows - 1), np.searchsorted(at, (at // DAY_US - 1) * DAY_US))
    there = ~np.isnan(value)
    units = np.where(there, np.rint(value * 10 ** SCALE), 0).astype(object)  # exact whole numbers, as in batch
    total, count = np.concatenate([[0], np.cumsum(units)]), np.concatenate([[0], np.cumsum(there)])
    place = np.arange(len(kept_at), len(at))
    sums, counts = total[place + 1] - total[first[place]], count[place + 1] - count[first[place]]
    means = [float(s) / (float(c) * float(10 ** SCALE)) if c else None for s, c in zip(sums, counts, strict=True)]
    keep = max(len(at) - (rows - 1), 0)
    return (at[place], value[place], means, counts), (pending_at[n:], pending[n:], at[keep:], value[keep:])


def buckets_for(keys: int) -> int:
    """How many buckets ``keys`` keys need, so that one has ``KEYS_PER_BUCKET`` of them on average."""
    return max(1, -(-keys // KEYS_PER_BUCKET))


def unpacked(stored: tuple) -> dict:
    """State row -> {key: (pending_at, pending, kept_at, kept)}."""
    keys, (n_pending, n_kept, *rows) = stored[0], (np.frombuffer(x, t) for x, t in zip(stored[1:], STATE_TYPES, strict=True))
    ends = [np.cumsum(n)[:-1] for n in (n_pending, n_pending, n_kept, n_kept)]
    return dict(zip(keys, zip(*(np.split(x, e) for x, e in zip(rows, ends, strict=True)), strict=True), strict=True))


def packed(groups: dict) -> tuple:
    """{key: (pending_at, pending, kept_at, kept)} -> state row."""
    rows = [np.concatenate(x) for x in zip(*groups.values(), strict=True)]
    counts = [np.array([len(g[i]) for g in groups.values()]) for i in (0, 2)]
    return (list(groups), *(x.astype(t).tobytes() for x, t in zip([*counts, *rows], STATE_TYPES, strict=True)))


def rolling_rows_stream(readings: DataFrame, delay: str, value: str = "o3", rows: int = 8, key: str = "location_id",
                        ts: str = "measured_at", buckets: int = BUCKETS) -> DataFrame:
    """(key, ts, value, rolling_<value>, count_<value>), append mode: each reading that is not late, once the
    watermark (``delay`` behind the newest) has passed it. Two readings of one key and time: the later to
    arrive replaces the other while it is pending. ``buckets``: the groups that the keys are dealt to
    (``buckets_for``); all runs of a checkpoint need the same number."""
    def step(bucket, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        groups = unpacked(state.get) if state.exists else {}
        none = (np.empty(0, AT), np.empty(0, VALUE), np.empty(0, AT), np.empty(0, VALUE))
        if not state.hasTimedOut:
            arrived = pd.concat(list(frames), ignore_index=True)
            # Rows without a key have a bucket of their own.
            names = [(None, arrived)] if bucket[0] is None or pd.isna(bucket[0]) else arrived.groupby("key", sort=False)
            for name, part in names:
                pending_at, pending, kept_at, kept = groups.get(name, none)
                pending_at = np.concatenate([pending_at, part["us"].to_numpy(AT)])
                pending = np.concatenate([pending, part["value"].to_numpy(VALUE)])
                # The last to arrive of each time stays.
                _, last = np.unique(pending_at[::-1], return_index=True)
                groups[name] = (pending_at[::-1][last], pending[::-1][last], kept_at, kept)
        until = state.getCurrentWatermarkMs() * 1000
        settled = []
        for name, group in groups.items():
            (at, values, means, counts), groups[name] = passed(*group, until, rows)
            if len(at):
                settled.append(pd.DataFrame({"key": pd.Series([name] * len(at), dtype=object), "us": at, "value": values,
                                             "mean": pd.Series(means, dtype=object), "n": counts.astype(np.int64)}))
        state.update(packed(groups))
        oldest = [int(g[0][0]) for g in groups.values() if len(g[0])]
        if oldest:
            # Called again when the watermark reaches the oldest pending row of the bucket.
            state.setTimeoutTimestamp(max(min(oldest) // 1000 - 1, state.getCurrentWatermarkMs() + 1))
        if settled:
            yield pd.concat(settled, ignore_index=True)

    kind = readings.schema[key].dataType.simpleString()
    source = readings.withWatermark(ts, delay).select(F.col(key).alias("key"), ts, F.unix_micros(ts).alias("us"),
                                                      F.col(value).cast("double").alias("value"))
    bucket = F.when(F.col("key").isNotNull(), F.pmod(F.xxhash64("key"), F.lit(buckets)))
    out = source.withColumn("bucket", bucket).groupBy("bucket").applyInPandasWithState(
        step, f"key {kind}, us bigint, value double, mean double, n bigint", STATE.format(kind=kind), "append",
        GroupStateTimeout.EventTimeTimeout)
    return out.select(F.col("key").alias(key), F.timestamp_micros("us").alias(ts), F.nanvl("value", F.lit(None)).alias(value),
                      F.col("mean").alias(f"rolling_{value}"), F.col("n").alias(f"count_{value}"))


def run_counting_late(stream: DataFrame, path: str, checkpoint_location: str) -> Ran:
    """Process what is there now, append to the parquet table at ``path``, stop; a later run goes on from the
    checkpoint, with the same state and watermark."""
    query = (stream.writeStream.format("parquet").outputMode("append").option("path", path)
             .option("checkpointLocation", checkpoint_location).trigger(availableNow=True).start())
    query.awaitTermination()
    progress = query.recentProgress
    return Ran(sum(p.numInputRows for p in progress),
               sum(s.numRowsDroppedByWatermark for p in progress for s in p.stateOperators),
               len({p.batchId for p in progress}))
