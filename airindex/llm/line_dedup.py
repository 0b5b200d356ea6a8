"""Line dedup (operator 3): drop the lines that many documents share.

Every whole text is split at ``\\n``; only (hash, document, position) rows travel. They are
range-partitioned by hash, then document, so that one very common line spreads over several
tasks, and sorted there by document and position: the first occurrence of a line in a
document is the row whose predecessor differs. Counting first occurrences per hash combines
on the map side. The result is a compressed bitmap per document, not text: 64-line words
of keep bits, and only the words that drop a line.

Nulls: a null text is one empty line; a null doc_id is an id like any other. Rows that repeat
a doc_id with the same text are one document, with another text another document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from airindex.llm.common import line_key, lines_of, materialize, packed, text_id, unpacked

WORD_BITS = 64


def line_occurrences(docs: DataFrame) -> DataFrame:
    """doc_id, tid, pos, h: one row per line with a key of at least one code point."""
    lines = docs.select("doc_id", text_id(F.col("text")).alias("tid"),
                        F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    return (lines.select("doc_id", "tid", "pos", line_key(F.col("line")).alias("key"))
            .filter(F.col("key") != "")
            .select("doc_id", "tid", "pos", F.xxhash64("key").alias("h")))


def keep_bitmaps(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """doc_id, tid, n_dropped, keep: array<struct<word, bits>>, for documents that lose lines.

    Bit ``p % 64`` of word ``p div 64`` tells whether line p stays; a word that is not listed
    keeps all its lines. Documents not listed keep everything.
    """
    occurrences = materialize(line_occurrences(docs), "lines")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = occurrences.repartitionByRange(parts, "h", "doc_id", "tid")
    in_doc = Window.partitionBy("h", "doc_id", "tid").orderBy("pos")
    firsts = ranged.withColumn("first", F.row_number().over(in_doc) == 1).filter("first")
    common = (firsts.groupBy("h").agg(F.count("*").alias("n_docs"))
              .filter(F.col("n_docs") >= min_docs).select("h"))
    return bitmaps_of(occurrences.join(common, "h", "left_semi"), "doc_id", "tid")


def bitmaps_of(dropped: DataFrame, *keys: str) -> DataFrame:
    """keys, n_dropped, keep, from the keys and pos of every dropped line."""
    words = dropped.groupBy(*keys, F.expr(f"pos div {WORD_BITS}").cast("int").alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, pos % {WORD_BITS})")).alias("drop_bits"),
        F.count("*").alias("n"))
    return words.groupBy(*keys).agg(
        F.sum("n").alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("drop_bits").alias("bits")))).alias("keep"))


def kept_lines(lines: Column, keep: Column) -> Column:
    """The lines that the map ``keep`` (word to bits) leaves, as one text."""
    return F.array_join(F.filter(lines, lambda line, p: F.getbit(
        F.coalesce(F.try_element_at(keep, F.floor(p / WORD_BITS).cast("int")), F.lit(-1).cast("long")),
        p % WORD_BITS) == 1), "\n")


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """row (all columns of docs), n_lines, n_dropped, kept_text: a row per row of docs."""
    marks = bitmaps.select(F.col("doc_id").alias("d"), F.col("tid").alias("t"), "n_dropped",
                           F.map_from_entries("keep").alias("keep"))
    rows = packed(docs).join(marks, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tid") == F.col("t")), "left")
    rows = rows.withColumn("lines", lines_of(F.col("text")))
    kept = F.when(F.col("keep").isNull(), F.coalesce("text", F.lit(""))).otherwise(
        kept_lines(F.col("lines"), F.col("keep")))
    return rows.select("row", F.size("lines").cast("long").alias("n_lines"),
                       F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept_text"))


def line_dedup(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """row (all columns of docs), n_lines, n_dropped, kept_text."""
    return apply_bitmaps(docs, keep_bitmaps(docs, min_docs))


def drop_common_lines(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """docs without the lines that ``min_docs`` documents share."""
    return unpacked(line_dedup(docs, min_docs), docs.columns, F.col("n_dropped") > 0, F.col("kept_text"))


def op3(docs: DataFrame) -> DataFrame:
    """The contract's digest: whole ``documents`` in, one row per document out."""
    out = line_dedup(docs.select("doc_id", "text"))
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS p FROM d),
k AS (SELECT doc_id, line, p, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
common AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT doc_id, line, p, key IN (SELECT key FROM common) AS gone FROM k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
