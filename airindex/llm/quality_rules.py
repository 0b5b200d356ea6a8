"""Quality rules (operator 6): document statistics and cross-document line frequency.

Base statistics come from one pass over the whole text. Beyond them, lines are normalised and
hashed, and the distinct documents that hold a line are counted per host (``source``; copies of
one text are one document). Lines above the host's limit are boilerplate and removed; a document
that keeps too few of its words without them is depleted and rejected.

The limit: a line found in at least ``min_docs`` distinct documents of a host and in at least the square
root of their number, so that it rises with the host far slower than the host itself. Depleted: less than
``min_left`` of the words remain.

Nulls: a null text has no words (and so fails); a null source is a host of its own; a null doc_id
is an id like any other; a repeated row gets its verdict each time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airindex.llm.common import BLANKS, line_key, lines_of, materialize, n_words, packed, text_id, unpacked
from airindex.llm.line_dedup import bitmaps_of, kept_lines

SYMBOLS = "#*$%&|<>"
KEYS = ("doc_id", "host", "tid")


def _host(source: str = "source"):
    # A prefix keeps a null source apart from an empty one.
    return F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))


def base_statistics(docs: DataFrame) -> DataFrame:
    """KEYS, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = F.coalesce("text", F.lit(""))
    d = docs.select("doc_id", _host().alias("host"), text_id(F.col("text")).alias("tid"), text.alias("text"))
    # Each step is used more than once by the next, so Spark keeps it as a column.
    d = d.select(
        *KEYS,
        F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("words"),
        F.char_length(F.translate("text", BLANKS, "")).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split("text", "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "").alias("lines"))
    d = d.select(
        *KEYS, F.size("words").cast("long").alias("n_words"), "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("wh"))
    d = d.withColumn("windows", F.transform(
        F.slice("wh", 1, F.greatest(F.size("wh") - 2, F.lit(0))),
        lambda h, i: F.xxhash64(h, F.get("wh", i + 1), F.get("wh", i + 2)))).drop("wh")
    # Windows sorted by (hash, position) stand beside their equals.
    d = d.withColumn("sorted", F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
        .otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))).drop("windows")
    d = d.withColumn("twice", F.sort_array(F.transform(F.filter(
        F.transform("sorted", lambda x, i: F.struct(
            x["i"].alias("i"),
            ((x["h"] == F.coalesce(F.get("sorted", i + 1)["h"], F.bitwise_not(x["h"])))
             | (x["h"] == F.coalesce(F.get("sorted", i - 1)["h"], F.bitwise_not(x["h"])))).alias("twice"))),
        lambda x: x["twice"]), lambda x: x["i"]))).drop("sorted")
    # Each repeated window covers 3 words, as far as the next one leaves them.
    repeat = F.aggregate(
        "twice", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
        lambda s, i: F.struct((s["n"] + F.least(F.lit(3), i - s["last"])).cast("long").alias("n"), i.alias("last")),
        lambda s: s["n"])
    d = d.withColumn("n_repeat_words", repeat).drop("twice")
    return d.withColumn("base_failed", (F.col("n_words") < 50)
                        | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def frequent_lines(lines: DataFrame, hosts: DataFrame, min_docs: int) -> DataFrame:
    """host, h of the lines above their host's limit."""
    held = lines.select("host", "h", "tid").distinct()
    counts = held.groupBy("host", "h").agg(F.count("*").alias("n")).filter(F.col("n") >= min_docs)
    return (counts.join(hosts, "host").filter(F.col("n") >= F.sqrt("host_docs"))
            .select("host", "h"))


def removed_lines(docs: DataFrame, min_docs: int) -> DataFrame:
    """KEYS, pos, w (words) of the lines above the limit."""
    own = docs.select("doc_id", _host().alias("host"), text_id(F.col("text")).alias("tid"), "text")
    hosts = own.select("host", "tid").distinct().groupBy("host").agg(F.count("*").alias("host_docs"))
    lines = materialize(
        own.select(*KEYS, F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
        .select(*KEYS, "pos", n_words(F.col("line")).alias("w"), line_key(F.col("line")).alias("key"))
        .filter("w > 0").select(*KEYS, "pos", "w", F.xxhash64("key").alias("h")), "rule-lines")
    above = frequent_lines(lines, hosts, min_docs)
    # Rows that repeat a document (same id, host and text) hold the same lines: one of each counts.
    return lines.join(above, ["host", "h"], "left_semi").groupBy(*KEYS, "pos").agg(F.max("w").alias("w"))


def verdicts(docs: DataFrame, removed: DataFrame, min_left: float) -> DataFrame:
    """One row per row of docs: doc_id, host, tid, the statistics, base_failed, n_left_words, kept."""
    base = base_statistics(docs)
    lost = removed.groupBy(*KEYS).agg(F.sum("w").alias("lost"))
    on = [base[k].eqNullSafe(lost[k]) for k in KEYS]
    out = base.join(lost, on, "left").select(*[base[c] for c in base.columns], F.coalesce("lost", F.lit(0)).alias("lost"))
    out = out.withColumn("n_left_words", F.col("n_words") - F.col("lost"))
    depleted = F.col("n_left_words") < min_left * F.col("n_words")
    return out.withColumn("kept", ~F.col("base_failed") & ~depleted).drop("lost")


def quality_rules(docs: DataFrame, min_docs: int = 10, min_left: float = 0.3) -> DataFrame:
    """One row per row of docs: doc_id, tid, the statistics, n_left_words, base_failed, kept."""
    return verdicts(docs, removed_lines(docs.select("doc_id", "source", "text"), min_docs), min_left)


def keep_good(docs: DataFrame, min_docs: int = 10, min_left: float = 0.3) -> DataFrame:
    """The rows of docs whose verdict is kept, their texts without the lines above the limit."""
    own = docs.select("doc_id", "text", "source")
    removed = materialize(removed_lines(own, min_docs), "rule-removed")
    bad = verdicts(own, removed, min_left).filter(~F.col("kept")).select(*KEYS, F.lit(True).alias("bad"), F.lit(None).alias("keep"))
    some = bitmaps_of(removed, *KEYS).select(*KEYS, F.lit(False).alias("bad"), "keep")
    # One row per document that goes or changes, so that the texts are joined once.
    marks = bad.unionByName(some).groupBy(*KEYS).agg(F.max("bad").alias("bad"), F.first("keep", True).alias("keep"))
    marks = marks.select(F.col("doc_id").alias("d"), F.col("host").alias("s"), F.col("tid").alias("t"), "bad",
                         F.map_from_entries("keep").alias("keep"))
    rows = packed(docs).withColumn("host", _host("row.source")).join(
        marks, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tid") == F.col("t")) & (F.col("host") == F.col("s")), "left")
    rows = rows.filter(~F.coalesce("bad", F.lit(False)))
    return unpacked(rows, docs.columns, F.col("keep").isNotNull(), kept_lines(lines_of(F.col("text")), F.col("keep")))


def op6(docs: DataFrame) -> DataFrame:
    return quality_rules(docs.select("doc_id", "text", "source")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_left_words")


SQL = r"""
WITH d AS (SELECT doc_id, coalesce('=' || source, '') AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
      list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
      length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
      length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols FROM d),
g AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS p FROM w WHERE len(ws) >= 3),
t AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, ws[p], ws[p + 1], ws[p + 2]) AS c FROM g),
r AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM t WHERE c > 1) GROUP BY doc_id),
hd AS (SELECT host, count(DISTINCT text) AS host_docs FROM d GROUP BY host),
l AS (SELECT doc_id, host, text, unnest(string_split(text, chr(10))) AS line FROM d),
k AS (SELECT doc_id, host, text, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key,
      len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS w FROM l),
f AS (SELECT k.host, key FROM k JOIN hd USING (host) WHERE w > 0 GROUP BY k.host, key
      HAVING count(DISTINCT text) >= 10 AND count(DISTINCT text) >= sqrt(any_value(host_docs))),
lost AS (SELECT doc_id, sum(w) AS lost FROM k JOIN f USING (host, key) GROUP BY doc_id),
o AS (SELECT doc_id, len(ws)::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
      (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
      (len(ws) - coalesce(lost, 0))::BIGINT AS n_left_words
      FROM w LEFT JOIN r USING (doc_id) LEFT JOIN lost USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM o)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT n_left_words < 0.3 * n_words AS kept, n_left_words FROM b
"""
