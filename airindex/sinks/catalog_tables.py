"""Tables by name: create if absent with a fixed schema, partitioning and place, then upsert and read.

Plain parquet tables of the session catalog; the folder is the table, so path writers and
readers by name see the same rows. Table formats with row-level operations have their own
MERGE (``operators.upsert.merge_into_table``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from airindex.operators.upsert import upsert_partitioned


def create_table(spark: SparkSession, name: str, schema: StructType, partition_col: str, path: str) -> None:
    """CREATE TABLE IF NOT EXISTS: external parquet, partitioned, at ``path``."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    place = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
              f"PARTITIONED BY (`{partition_col}`) LOCATION '{place}'")


def table_path(spark: SparkSession, name: str) -> str:
    """Where the catalog keeps the table."""
    rows = spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def upsert_table(spark: SparkSession, name: str, updates: DataFrame, keys: Sequence[str],
                 partition_col: str, update_cols: Sequence[str] | None = None,
                 order_by: str | None = None) -> DataFrame:
    """Keyed upsert into a table by name: its columns, no more and no less; returns the rejects."""
    schema = spark.table(name).schema
    have = set(updates.columns)
    missing = [f.name for f in schema if f.name not in have]
    extra = [c for c in updates.columns if c not in schema.fieldNames()]
    if missing or extra:
        raise ValueError(f"{name}: columns missing {missing}, not in the table {extra}")
    rejects = upsert_partitioned(spark, table_path(spark, name), updates.select(*schema.fieldNames()),
                                 keys, partition_col, update_cols, order_by, schema)
    # New partitions become visible, cached listings are dropped.
    spark.sql(f"MSCK REPAIR TABLE {name}")
    spark.catalog.refreshTable(name)
    return rejects
