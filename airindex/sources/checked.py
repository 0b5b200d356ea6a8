"""Landing payloads that may be damaged: checked reading, and a quarantine table for what is wrong.

A document is rejected if it cannot be parsed with the schema (``malformed``), or lacks the coordinates or the
list of measurements. An empty list is no damage: the day has no measurements. Rejected documents keep their
text, file and the file's time, one row each; the good ones go on as usual.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airindex.schemas import RAW
from airindex.session import scratch_path

CORRUPT = "_corrupt_payload"
REJECTED = "path string, modified timestamp, reason string, payload string"


def read_checked(spark: SparkSession, paths: str | Sequence[str], multi_line: bool = False, schema=RAW,
                 pattern: str = "*.json") -> DataFrame:
    """Payload rows with ``reason`` (NULL: good), ``payload`` (text of a bad one), ``path`` and ``modified``.

    ``multi_line``: a file is one document; else a line is. Every file below the paths whose name
    fits ``pattern`` is read.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    raw = (spark.read.schema(wide).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
           .option("multiLine", multi_line).option("recursiveFileLookup", True).option("pathGlobFilter", pattern).json(paths))
    known = F.struct(*[F.col(f.name) for f in schema.fields])
    reason = (F.when(F.col(CORRUPT).isNotNull(), "malformed")
              .when(F.col("coord.lon").isNull() | F.col("coord.lat").isNull(), "no_coordinates")
              .when(F.col("list").isNull(), "no_measurements"))
    return raw.select(*[f.name for f in schema.fields], reason.alias("reason"),
                      F.when(reason.isNotNull(), F.coalesce(F.col(CORRUPT), F.to_json(known))).alias("payload"),
                      F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("modified"))


def split_checked(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good payload rows, rejects). The text is parsed once: both read one written copy, split by a partition
    column, below the shared checkpoint folder."""
    at = scratch_path(checked.sparkSession, "checked")
    marked = checked.withColumn("bad", F.col("reason").isNotNull())
    marked.write.partitionBy("bad").parquet(at)
    both = checked.sparkSession.read.schema(marked.schema).parquet(at)
    extra = ("reason", "payload", "path", "modified", "bad")
    return (both.filter(~F.col("bad")).select(*[c for c in checked.columns if c not in extra]),
            both.filter("bad").select("path", "modified", "reason", "payload"))


def quarantine(rejects: DataFrame, table: str) -> None:
    """Append rejects to the quarantine table at ``table``; those it has already (same file, time and text,
    as often) are left out, so that a run that is repeated adds nothing."""
    spark = rejects.sparkSession
    key = ["path", "modified", "reason", "payload"]
    counted = rejects.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    try:
        held = spark.read.schema(REJECTED).parquet(table).groupBy(*key).agg(F.count(F.lit(1)).alias("held"))
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        held = spark.createDataFrame([], f"{REJECTED}, held long")
    new = counted.join(held, key, "left").withColumn("more", F.col("n") - F.coalesce("held", F.lit(0))).filter("more > 0")
    new.select(*key, F.explode(F.array_repeat(F.lit(1), F.col("more").cast("int"))).alias("_")).drop("_").write.mode("append").parquet(table)


def read_good(spark: SparkSession, paths: str | Sequence[str], quarantine_table: str, multi_line: bool = False,
              pattern: str = "*.json") -> DataFrame:
    """The good payload rows below ``paths``; the others go to the quarantine table."""
    good, rejects = split_checked(read_checked(spark, paths, multi_line, pattern=pattern))
    quarantine(rejects, quarantine_table)
    return good
