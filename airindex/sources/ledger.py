"""Incremental landing: a ledger of processed files, so that a run reads only new or changed ones.

A file is known by its path and modification time. What is listed but not in the ledger is new; the ledger
takes a run's files only when the run has written its result, so a run that fails is simply repeated (results
are keyed upserts). One writer at a time; the ledger is a parquet folder of small appends.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airindex.schemas import RAW
from airindex.session import scratch_path

LEDGER = "path string, modified timestamp, bytes long, processed_at timestamp"
FILES_PER_READ = 50_000  # paths named in one read; more files are several reads of one run


def landed_files(spark: SparkSession, root: str, pattern: str = "*.json") -> DataFrame:
    """path, modified, bytes of every file below ``root`` (a listing; no content is read)."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, modified timestamp, bytes long")
    return files.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER).parquet(ledger)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def unprocessed(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Listed files that the ledger does not have with this modification time."""
    return files.join(ledger.select("path", "modified"), ["path", "modified"], "left_anti")


def reads_of(files: DataFrame, schema=RAW, multi_line: bool = False) -> Iterator[DataFrame]:
    """Payload rows of the listed files, in reads of at most FILES_PER_READ files.

    The driver holds the new files' paths of one read, as it does for any listing.
    """
    spark, paths = files.sparkSession, []

    def read() -> DataFrame:
        return spark.read.schema(schema).option("multiLine", multi_line).json(paths).select(*[f.name for f in schema.fields])

    for row in files.select("path").toLocalIterator():
        paths.append(row["path"])
        if len(paths) == FILES_PER_READ:
            yield read()
            paths = []
    if paths:
        yield read()


def process_new(spark: SparkSession, root: str, ledger: str, process: Callable[[DataFrame], None],
                schema=RAW, multi_line: bool = False) -> DataFrame:
    """Give the payload rows of files not processed yet to ``process``, then enter them in the ledger.

    Returns the files of this run: path, modified, bytes. The listing is written once, so what is read and
    what is entered are the same even if files land meanwhile; a file that changes meanwhile is read again
    by the next run.
    """
    at = scratch_path(spark, "new-files")
    unprocessed(landed_files(spark, root), read_ledger(spark, ledger)).write.parquet(at)
    new = spark.read.parquet(at)
    for payload in reads_of(new, schema, multi_line):
        process(payload)
    if not new.isEmpty():
        new.withColumn("processed_at", F.current_timestamp()).write.mode("append").parquet(ledger)
    return new
