"""Substring dedup (operator 1): relative Lempel-Ziv parsing against indexed reference blocks.

A block holds stretches of many documents and an index over them: the suffix array of their words, ranks
of word runs of 1, 2, 4, ... words (which give the common prefix of any two suffixes), and the smallest
document over any part of the suffix array. Every stretch is factored greedily against what earlier
documents put into the block: each factor is the longest match of the text at the cursor, and the cursor
moves to its end. All stretches of a block move at once.

A factor of ``window`` words or more is a duplicate span. A duplicate window that is inside no factor
crosses exactly one factor boundary (the factor that starts at the boundary reaches at least to the
window's end), so matches are also looked for from the positions before a boundary whose two factors
together are long enough.

Which documents meet in which blocks follows from content-defined anchors (``anchors``): equal windows
always meet, so factoring against the blocks that share an anchor is factoring against all of them.

Nulls: a null text has no words; a null doc_id is the smallest id. Rows that share a doc_id are not earlier
than each other: nothing is removed because of the other row, and a span holds for its own text only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airindex.llm.anchors import join_by_doc, repeated_spans
from airindex.llm.common import plain_words, regroup, small_batches

WINDOW, GRAM = 50, 8


class ReferenceBlock:
    """Index over the words of a block's stretches, row after row; ``doc``: rank of each row's document."""

    def __init__(self, words: np.ndarray, bounds: np.ndarray, doc: np.ndarray, longest: int) -> None:
        # A separator of its own kind ends every row, so that no match leaves its row.
        rows, n = len(bounds) - 1, len(words)
        self.first = bounds[:-1] + np.arange(rows)
        self.size = n + rows
        text = np.empty(self.size, np.int64)
        at = np.arange(n) + np.repeat(np.arange(rows), np.diff(bounds))
        text[at] = words
        text[bounds[1:] + np.arange(rows)] = words.max(initial=-1) + 1 + np.arange(rows)
        self.doc = np.repeat(doc, np.diff(bounds) + 1).astype(np.int64)
        # ranks[j]: rank of the run of 2**j words at each position.
        self.ranks = [np.unique(text, return_inverse=True)[1].astype(np.int64)]
        step = 1
        while step < longest:
            after = np.zeros(self.size, np.int64)
            after[: self.size - step] = self.ranks[-1][step:] + 1
            key = self.ranks[-1] * (self.size + 2) + after
            self.ranks.append(np.unique(key, return_inverse=True)[1].astype(np.int64))
            step *= 2
        self.order = np.argsort(self.ranks[-1], kind="stable")
        self.at = np.empty(self.size, np.int64)
        self.at[self.order] = np.arange(self.size)
        # least[j][i]: smallest document among 2**j suffixes from the i-th on.
        self.least = [self.doc[self.order]]
        while 2 ** len(self.least) <= self.size:
            half = 2 ** (len(self.least) - 1)
            self.least.append(np.minimum(self.least[-1][:-half], self.least[-1][half:]))

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that the suffixes at a and b have in common."""
        out = np.zeros(len(a), np.int64)
        for j in reversed(range(len(self.ranks))):
            x, y = a + out, b + out
            inside = (x < self.size) & (y < self.size)
            same = inside & (self.ranks[j][np.minimum(x, self.size - 1)] == self.ranks[j][np.minimum(y, self.size - 1)])
            out += same.astype(np.int64) << j
        return out

    def longest_match(self, position: np.ndarray) -> np.ndarray:
        """Length of the longest match, in an earlier document, of the text at each position."""
        doc, here = self.doc[position], self.at[position]
        left, right = here.copy(), here + 1
        # Step over suffixes of later documents, in halving strides, to the nearest earlier one.
        for j in reversed(range(len(self.least))):
            stride = 1 << j
            to = left - stride
            free = (to >= 0) & (self.least[j][np.clip(to, 0, len(self.least[j]) - 1)] >= doc)
            left = np.where(free, to, left)
            free = (right + stride <= self.size) & (self.least[j][np.minimum(right, len(self.least[j]) - 1)] >= doc)
            right = np.where(free, right + stride, right)
        out = np.zeros(len(position), np.int64)
        some = np.flatnonzero(left > 0)
        out[some] = self.common(position[some], self.order[left[some] - 1])
        some = np.flatnonzero(right < self.size)
        out[some] = np.maximum(out[some], self.common(position[some], self.order[right[some]]))
        return out


def factor(block: ReferenceBlock, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Greedy parsing of all rows: (row, first word in the row, match length) of every factor, in order."""
    row, cursor = np.flatnonzero(words > 0), np.zeros(int((words > 0).sum()), np.int64)
    found: list[tuple[np.ndarray, ...]] = []
    while len(row):
        length = block.longest_match(block.first[row] + cursor)
        found.append((row, cursor, length))
        cursor = cursor + np.maximum(length, 1)
        more = cursor < words[row]
        row, cursor = row[more], cursor[more]
    if not found:
        return (np.empty(0, np.int64),) * 3
    row, first, length = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((first, row))
    return row[order], first[order], length[order]


def duplicate_spans(block: ReferenceBlock, words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, end) of the long factors and of the long matches across factor boundaries."""
    row, first, length = factor(block, words)
    long = length >= window
    out = [(row[long], first[long], first[long] + length[long])]
    # The boundary between factor i and factor i + 1 of a row.
    i = np.flatnonzero((row[1:] == row[:-1]) & (length[1:] + np.maximum(length[:-1], 1) >= window)) if len(row) > 1 else np.empty(0, np.int64)
    if len(i):
        edge = first[i + 1]
        low = np.maximum(first[i] + 1, edge - window + 1)
        count = np.maximum(np.minimum(edge - 1, edge + length[i + 1] - window) - low + 1, 0)
        at = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
        of = np.repeat(row[i], count)
        match = block.longest_match(block.first[of] + at)
        long = match >= window
        out.append((of[long], at[long], at[long] + match[long]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def parse_block(doc: np.ndarray, document: np.ndarray, start: np.ndarray, n: np.ndarray, texts: pa.Array):
    """Rows of one block to (row, first word, end word) of their duplicate spans."""
    data, starts, ends, bounds = plain_words(texts)
    # Words are numbered by their bytes, not by a hash.
    words = pa.array(data.tobytes().split(), pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    size = np.diff(bounds)
    block = ReferenceBlock(words, bounds, doc, int(size.max(initial=1)))
    return duplicate_spans(block, size, WINDOW)


def removed_words(n: int, spans: list | None) -> np.ndarray:
    """Which of n words the spans cover; spans beyond the text are cut off."""
    steps = np.zeros(n + 1, np.int64)
    if spans:
        a = np.minimum([s["start"] for s in spans], n)
        b = np.minimum([s["end"] for s in spans], n)
        np.add.at(steps, a, 1)
        np.add.at(steps, b, -1)
    return np.cumsum(steps[:n]) > 0


def substring_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words that stay, one space between): a row per row of docs."""
    spans = repeated_spans(docs, WINDOW, GRAM, True, False, parse_block).select(F.col("doc_id").alias("_d"), F.col("tid").alias("_t"), "spans")
    small_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches, "text"):
            n_words, n_removed, kept = [], [], []
            for text, marks in zip(batch.column("text").fill_null("").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                own = text.encode().split()
                gone = removed_words(len(own), marks) if marks else None
                n_words.append(len(own))
                n_removed.append(int(gone.sum()) if marks else 0)
                kept.append(b" ".join(own if not marks else [own[i] for i in np.flatnonzero(~gone)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    joined = join_by_doc(docs, spans, "left")
    return joined.select("doc_id", "text", "spans").mapInArrow(cut, f"doc_id {kind}, n_words long, n_removed long, kept string")


def op1(docs: DataFrame) -> DataFrame:
    return substring_dedup(docs.select("doc_id", "text")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT doc_id, p, md5(array_to_string(ws[p:p + 49], ' ')) AS h FROM
    (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS p FROM d WHERE len(ws) >= 50)),
later AS (SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY h) AS m FROM g) WHERE m < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS q FROM later),
w AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS q FROM d WHERE len(ws) > 0),
k AS (SELECT w.doc_id, count(*) FILTER (gone.q IS NOT NULL) AS n_removed,
      string_agg(word, ' ' ORDER BY w.q) FILTER (gone.q IS NULL) AS kept
      FROM w LEFT JOIN gone ON w.doc_id = gone.doc_id AND w.q = gone.q GROUP BY w.doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
