"""Corpus pipeline: five stages over ``documents``, each calling one operator of airindex.llm.

Every stage function takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's
result as Parquet below the shared checkpoint folder and rereads it as the next one's docs. All but the
last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from airindex.llm.common import materialize, table
from airindex.llm.decontaminate import decontaminate
from airindex.llm.line_dedup import drop_common_lines
from airindex.llm.mixing import mix_documents
from airindex.llm.near_dup import keep_one_of_each
from airindex.llm.quality_rules import keep_good


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents they reject go, and lines above their host's limit."""
    return keep_good(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: lines that ten or more documents share go."""
    return drop_common_lines(docs)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: one document of each class stays."""
    return keep_one_of_each(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: words inside benchmark windows are cut out."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: the documents that the mix takes, with their size and the words taken."""
    return mix_documents(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("MinHash near-dedup", near_dup_stage),
    ("benchmark decontamination", benchmark_stage),
    ("mixing sources to target weights", mixing_stage),
]

#: Near-duplicate classes are no SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
