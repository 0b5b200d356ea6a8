"""Places of rows in sorted groups, and row windows over numbered segments, for groups of any size.

``number_rows`` gives every row its place within its group without one task sorting the group: rows are
range-partitioned and written in order, a place is the row's place in its partition plus the rows of its group
in earlier ones. ``rolling_rows_dense`` cuts a group into segments of as many rows as fit a task; the last rows
of a segment go along with the next one, so that frames reach back over the cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airindex.functions.exact import SCALE, units
from airindex.session import scratch_path

PLACE = "_place"
_LOW = (1 << 33) - 1  # monotonically_increasing_id: partition above, place in it below


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], place: str = PLACE) -> DataFrame:
    """df with each row's place (0, 1, ...) in its group of ``keys`` by ``order``; NULLs sort first.

    ``order`` should be total within a group. The sorted rows are written once below the shared checkpoint
    folder; one small row per group and partition carries the counts.
    """
    spark, keys = df.sparkSession, list(keys)
    at = scratch_path(spark, "numbered")
    ordered = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    ordered.withColumn("_at", F.monotonically_increasing_id()).write.parquet(at)
    rows = spark.read.parquet(at).withColumn("_part", F.shiftright("_at", 33))
    counts = rows.groupBy(*keys, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_part").alias("_p"),
                           (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first").bitwiseAND(_LOW)).alias("_shift"))
    same = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return rows.join(shifts, same).select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_at").bitwiseAND(_LOW) + F.col("_shift")).alias(place))


def running_totals(df: DataFrame, keys: Sequence[str], order: Sequence[str], weight: str, total: str = "_before") -> DataFrame:
    """df with the sum of ``weight`` over the earlier rows of its group of ``keys``, by ``order``."""
    spark, keys = df.sparkSession, list(keys)
    at = scratch_path(spark, "totals")
    df.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id()).write.parquet(at)
    rows = spark.read.parquet(at)
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy(*keys, "_part").agg(F.sum(weight).alias("_n"))
    parts = parts.withColumn("_shift", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    inside = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = rows.withColumn("_own", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    return own.join(parts, [*keys, "_part"]).withColumn(total, F.col("_own") + F.col("_shift")).drop("_own", "_shift", "_part")


def rolling_rows_dense(df: DataFrame, value: str, keys: Sequence[str], order: Sequence[str], rows: int = 8,
                       segment: int = 1 << 16) -> DataFrame:
    """df with ``rolling_<value>`` and ``count_<value>``: mean and count over the row and the ``rows - 1`` before it
    in its group. A task's window holds ``segment + rows - 1`` rows at most, however many a group has."""
    if rows > segment:
        raise ValueError("a segment must hold a whole frame")
    numbered = number_rows(df, keys, order)
    own = F.floor(F.col(PLACE) / segment)
    ahead = (F.col(PLACE) % segment) >= segment - (rows - 1)
    dealt = numbered.withColumn("_own", own).withColumn("_segment", F.explode(F.when(ahead, F.array(own, own + 1)).otherwise(F.array(own))))
    w = Window.partitionBy(*keys, "_segment").orderBy(PLACE).rowsBetween(-(rows - 1), 0)
    total, count = F.sum(units(value)).over(w).cast("double"), F.count(value).over(w)
    out = dealt.withColumns({"_total": total, f"count_{value}": count}).filter(F.col("_segment") == F.col("_own"))
    mean = F.when(F.col(f"count_{value}") > 0, F.col("_total") / (F.col(f"count_{value}") * float(10 ** SCALE)))
    return out.withColumn(f"rolling_{value}", mean).drop("_total", "_own", "_segment", PLACE)
