"""File sinks and their readers: partitioned parquet, CSV report extracts, latest export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airindex.schemas import REPORT


def write_partitioned(df: DataFrame, path: str, partition_col: str = "measure_date",
                      mode: str = "overwrite") -> None:
    """Parquet partitioned by day; overwrite replaces only the partitions present.

    ``rebalance`` clusters rows by day so each task writes few files, and lets
    adaptive execution split a day that holds a large share of the rows over
    several tasks (a plain ``repartition(day)`` would put it in one task).
    """
    (df.hint("rebalance", partition_col).write.mode(mode)
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header, overwrite. ``single_file`` funnels everything through one task:
    only for small extracts."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def read_report_csv(spark: SparkSession, path: str) -> DataFrame:
    """Report extract with its explicit schema; ``year`` / ``month`` re-derived from the date."""
    df = spark.read.schema(REPORT).option("header", True).csv(path)
    return df.withColumns({"year": F.year("measure_date"), "month": F.month("measure_date")})


def latest_export(df: DataFrame, root: str, export_col: str = "export") -> DataFrame:
    """Rows of the most recently written export below ``root`` (by file modification time).

    ``df`` reads the folder of exports, one sub-folder (partition value of ``export_col``) per
    write. File times come from the file listing (path and time only, no content), and the
    newest export is a partition filter, so the other exports are not read.
    """
    files = (df.sparkSession.read.format("binaryFile").option("recursiveFileLookup", True)
             .load(root).select("path", "modificationTime"))
    written = files.select(F.regexp_extract("path", f"/{export_col}=([^/]*)/", 1).alias("name"),
                           "modificationTime").filter("name <> ''")
    newest = written.agg(F.max_by("name", F.struct("modificationTime", "name"))).first()[0]
    if newest is None:
        return df.limit(0)
    return df.filter(F.col(export_col) == F.lit(newest).cast(df.schema[export_col].dataType))
