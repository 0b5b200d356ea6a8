"""Bucketed tables: merges and windows by location that read the table without moving it.

A table is bucketed by its location and sorted by location and time within a bucket. Joined or windowed by
keys that begin with the location, its files are read bucket by bucket, so only the updates are shuffled (to
the table's buckets). Every merge writes the next version beside the last one and then points the table to
it, so readers never see a half-written version.

A merge turns ``spark.sql.requireAllClusterKeysForCoPartition`` off while it runs: otherwise Spark wants both
sides of a join hashed by all join keys, and would move the table. A location is one bucket's business: buckets are sized by
the number of locations, and a location with far more rows than others makes its bucket large.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from airindex.operators.upsert import merge_frames
from airindex.session import scratch_path

SUBSET_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
PARTITIONS = "spark.sql.shuffle.partitions"


def save_bucketed(df: DataFrame, table: str, buckets: int, by: Sequence[str] = ("location_id",),
                  sort: Sequence[str] = ("location_id", "measured_at"), path: str | None = None) -> None:
    """Write ``df`` as the catalog table ``table``, a file per bucket."""
    path = path or scratch_path(df.sparkSession, table)
    (df.repartition(buckets, *by).write.format("parquet").option("path", path).mode("errorifexists")
     .bucketBy(buckets, *by).sortBy(*sort).saveAsTable(table))


def merge_bucketed(spark: SparkSession, table: str, updates: DataFrame, keys: Sequence[str], update_cols: Sequence[str] | None = None,
                   buckets: int = 8, by: Sequence[str] = ("location_id",), sort: Sequence[str] = ("location_id", "measured_at"),
                   path: str | None = None) -> str:
    """Merge ``updates`` into ``table`` and make the result its next version; the new version's path.

    The table's side of the merge is not shuffled. The version before stays where it is, for readers
    that have begun; remove it when they are done.
    """
    at = path or scratch_path(spark, table)
    staged = f"{table}_next"
    with table_stays(spark, buckets):
        merged = merge_frames(spark.table(table), updates, keys, update_cols)
        (merged.write.format("parquet").option("path", at).mode("errorifexists").bucketBy(buckets, *by).sortBy(*sort).saveAsTable(staged))
    # The catalog entry moves; both entries are of external files, so dropping one deletes nothing.
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{at}'")
    spark.sql(f"DROP TABLE {staged}")
    spark.catalog.refreshTable(table)
    return at


@contextmanager
def table_stays(spark: SparkSession, buckets: int):
    """Joins planned inside use a side's ``buckets`` by a part of the join keys; the settings are put back.

    Spark prefers its own number of shuffle partitions to fewer buckets, so that number is lowered to theirs.
    """
    before = {key: spark.conf.get(key) for key in (SUBSET_KEYS, PARTITIONS)}
    spark.conf.set(SUBSET_KEYS, "false")
    spark.conf.set(PARTITIONS, str(min(int(before[PARTITIONS]), buckets)))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
