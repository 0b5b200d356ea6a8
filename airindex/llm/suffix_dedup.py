"""Suffix-array dedup (operator 8): column-wise construction over many stretches at once.

A block is a collection of byte stretches. Its Burrows-Wheeler transform is built right to left: in every
round each stretch inserts one more symbol, that is the suffix that is one byte longer. The place of a
suffix cS follows from the place of S and the ranks of c in the transform so far (equal symbols keep their
order), so a round sorts one column, merges the new entries into the sequence, and updates the common
prefix lengths beside them: one more than the least of the lengths between the places of the two tails, and
nothing where the first symbols differ. The sequences (symbol, stretch, suffix length, common prefix) are
read and rewritten front to back, as external files would be; a block is small enough for them to be
arrays of its task, as machine-local files are of no use on a cluster.

Suffixes with a common prefix of ``window`` bytes stand together; all but the earliest are repeats.

Blocks follow from content-defined anchors (``anchors``), so that equal windows always meet. Windows whose
hash is alone in the block cannot be repeated and are cut off before construction.

Nulls: a null text is empty; a null doc_id is the smallest id. Rows that repeat a doc_id and a text are one
document (a place counts once); rows that share a doc_id alone are not earlier than each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airindex.llm.anchors import join_by_doc, repeated_spans
from airindex.llm.common import ByteHash, merge_spans, regroup, small_batches, text_bytes

WINDOW, GRAM = 100, 32


def collection_index(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stretch, suffix length, common prefix with the entry before) in the order of all suffixes.

    Stretch i is data[first[i] : first[i] + size[i]]. Symbol 0 ends a stretch; byte b is symbol b + 1.
    """
    count = len(first)
    code = data.astype(np.uint8) + np.uint8(1)  # UTF-8 has no byte 255
    last = first + size - 1
    symbol = np.where(size > 0, code[np.maximum(last, 0)], 0).astype(np.uint8)  # what stands before each suffix
    stretch = np.arange(count, dtype=np.int32)
    length = np.zeros(count, np.int32)
    prefix = np.zeros(count, np.int32)
    newest = np.ones(count, bool)
    for t in range(1, int(size.max(initial=0)) + 1):
        # Places of all suffixes c S: by c, then by the place of S.
        order = np.argsort(symbol, kind="stable")
        order = order[int((symbol == 0).sum()):]
        fresh = newest[order]
        old_rows = len(symbol)
        new = np.zeros(count + len(order), bool)
        new[count:] = fresh
        where = np.flatnonzero(fresh)
        tails = order[where]
        owner = stretch[tails]
        # Common prefixes of the new entries and of those right after them.
        touched = np.unique(np.concatenate([where, where + 1]))
        touched = touched[touched < len(order)]
        here = order[touched]
        before = order[np.maximum(touched - 1, 0)]
        same = (touched > 0) & (symbol[before] == symbol[here])
        ends = np.column_stack([before[same] + 1, here[same] + 1]).ravel()
        value = np.zeros(len(touched), np.int32)
        if len(ends):
            value[same] = 1 + np.minimum.reduceat(np.append(prefix, np.int32(0)), ends)[::2]
        rest = size[owner] - t
        preceding = np.where(rest > 0, code[np.maximum(first[owner] + rest - 1, 0)], 0).astype(np.uint8)

        def merged(old: np.ndarray, entries: np.ndarray) -> np.ndarray:
            out = np.empty(len(new), old.dtype)
            out[~new] = old
            out[new] = entries
            return out

        assert old_rows + len(where) == len(new)
        symbol, stretch = merged(symbol, preceding), merged(stretch, owner)
        length, prefix = merged(length, np.full(len(where), t, np.int32)), merged(prefix, np.zeros(len(where), np.int32))
        prefix[count + touched] = value
        newest = new
    return stretch, length, prefix


def repeats(doc: np.ndarray, document: np.ndarray, start: np.ndarray, first: np.ndarray, size: np.ndarray, data: np.ndarray,
            window: int) -> tuple[np.ndarray, np.ndarray]:
    """(stretch, offset) of every window that also starts earlier."""
    stretch, length, prefix = collection_index(data, first, size)
    group = np.cumsum(prefix < window)
    whole = length >= window
    stretch, group = stretch[whole], group[whole]
    offset = size[stretch] - length[whole]
    place = start[stretch] + offset
    order = np.lexsort((place, document[stretch], group))
    g, d, m, p = group[order], doc[stretch][order], document[stretch][order], place[order]
    if len(g) == 0:
        return stretch, offset
    index = np.arange(len(g))
    head = np.r_[True, g[1:] != g[:-1]]
    own = head | np.r_[True, m[1:] != m[:-1]]
    lead, own_lead = np.maximum.accumulate(np.where(head, index, 0)), np.maximum.accumulate(np.where(own, index, 0))
    later = (d != d[lead]) | (p != p[own_lead])
    return stretch[order][later], offset[order][later]


def compare_block(doc: np.ndarray, document: np.ndarray, start: np.ndarray, n: np.ndarray, texts: pa.Array):
    """Rows of one block to (row, first byte, end byte) of their repeated spans."""
    data, bounds = text_bytes(texts)
    row = np.repeat(np.arange(len(n)), n)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    at = bounds[row] + offset
    h = ByteHash(data)(at, at + WINDOW)
    _, inverse, times = np.unique(h, return_inverse=True, return_counts=True)
    shared = times[inverse] > 1
    row, offset = row[shared], offset[shared]
    if len(row) == 0:
        return (np.empty(0, np.int64),) * 3
    # The stretches of consecutive shared windows.
    new = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (offset[1:] != offset[:-1] + 1)])
    owner, low = row[new], offset[new]
    size = offset[np.append(new[1:], len(row)) - 1] + WINDOW - low
    piece, inside = repeats(doc[owner], document[owner], start[owner] + low, bounds[owner] + low, size, data, WINDOW)
    begin = low[piece] + inside
    # Overlapping windows of a row as one span.
    shift = owner[piece] * (int(np.diff(bounds).max()) + WINDOW + 1)
    a, b = merge_spans(shift + begin, shift + begin + WINDOW)
    of = a // (int(np.diff(bounds).max()) + WINDOW + 1)
    base = of * (int(np.diff(bounds).max()) + WINDOW + 1)
    return of, a - base, b - base


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary: the bytes that stay): a row per row of docs."""
    spans = repeated_spans(docs, WINDOW, GRAM, False, True, compare_block).select(F.col("doc_id").alias("_d"), F.col("tid").alias("_t"), "spans")
    small_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches, "text"):
            n_bytes, n_removed, n_spans, kept = [], [], [], []
            for text, marks in zip(batch.column("text").fill_null("").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                own = text.encode()
                a, b = merge_spans(np.minimum([s["start"] for s in marks], len(own)),
                                   np.minimum([s["end"] for s in marks], len(own))) if marks else ([], [])
                pieces, at = [], 0
                for x, y in zip(a, b, strict=True):
                    pieces.append(own[at:x])
                    at = y
                left = b"".join([*pieces, own[at:]])
                n_bytes.append(len(own))
                n_removed.append(len(own) - len(left))
                n_spans.append(sum(x < y for x, y in zip(a, b, strict=True)))
                kept.append(left)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    joined = join_by_doc(docs, spans, "left")
    return joined.select("doc_id", "text", "spans").mapInArrow(
        cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")


def op8(docs: DataFrame) -> DataFrame:
    return suffix_dedup(docs.select("doc_id", "text")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS bs FROM documents),
g AS (SELECT doc_id, p, md5(array_to_string(bs[p:p + 99], '')) AS h FROM
    (SELECT doc_id, bs, unnest(range(1, len(bs) - 98)) AS p FROM d WHERE len(bs) >= 100)),
later AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY h ORDER BY doc_id, p) AS r FROM g) WHERE r > 1),
marked AS (SELECT doc_id, p, (p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100)::INT AS apart FROM later),
numbered AS (SELECT doc_id, p, sum(coalesce(apart, 0)) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM marked),
spans AS (SELECT doc_id, min(p) AS a, max(p) + 99 AS b FROM numbered GROUP BY doc_id, run),
lists AS (SELECT doc_id, list(a ORDER BY a) AS aa, list(b ORDER BY a) AS bb, count(*) AS n, sum(b - a + 1)::BIGINT AS gone FROM spans GROUP BY doc_id)
SELECT doc_id, len(bs)::BIGINT AS n_bytes, coalesce(gone, 0) AS n_removed, coalesce(n, 0) AS n_spans,
  sha256(unhex(CASE WHEN n IS NULL THEN array_to_string(bs, '') ELSE array_to_string(flatten(list_transform(range(n + 1),
    lambda i: bs[(CASE WHEN i = 0 THEN 1 ELSE bb[i] + 1 END):(CASE WHEN i = n THEN len(bs) ELSE aa[i + 1] - 1 END)])), '') END)) AS kept_sha256
FROM d LEFT JOIN lists USING (doc_id)
"""
