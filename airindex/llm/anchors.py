"""Finding where long repeats can be: content-defined anchors and the stretches around them.

Every window of ``window`` symbols chooses one anchor, its gram of ``gram`` symbols with the smallest
hash (ties: the leftmost), so equal windows choose equal anchors at equal places, whatever batch they are in. Consecutive windows
with the same anchor are a run; a run's text is its stretch. Two windows can be equal only inside
stretches of one anchor, so whatever compares stretches by anchor sees every repeat, and each text is
compared only with the parts of the corpus that can hold a repeat of it.

Stretches with equal text (by a digest whose key is drawn for the run, so that no two texts can be made to
collide) need no comparison: all but the earliest are repeats as a whole. What is left
are the earliest stretches of anchors with two texts or more (``rivals``). They are read from the texts
again and dealt out to blocks by anchor. An anchor with more rivals than ``max_rivals`` would be an
unbounded group: its windows are counted one by one instead, by hash, with map-side combining.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from airindex.llm.common import ByteHash, materialize, plain_words, regroup, small_batches, text_bytes, text_id

MAX_RIVALS = 2000
PERIOD_WINDOWS = 64
BLOCK_BYTES = 4 << 20


class Symbols:
    """Texts as symbols: ``data`` holds them, symbol i is the bytes starts[i] to ends[i]."""

    def __init__(self, texts: pa.Array, by_word: bool) -> None:
        self.by_word = by_word
        if by_word:
            self.data, self.starts, self.ends, self.bounds = plain_words(texts)
        else:
            self.data, self.bounds = text_bytes(texts)
        self.hash = ByteHash(self.data)

    def span(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte range of symbols first to last (exclusive)."""
        return (self.starts[first], self.ends[last - 1]) if self.by_word else (first, last)

    def hashes(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hashes that only choose and route; nothing is taken as equal because of them."""
        return self.hash(*self.span(first, last))

    def digests(self, first: np.ndarray, last: np.ndarray, key: bytes) -> np.ndarray:
        """Keyed digests of the symbols first to last: equal for equal texts only."""
        if len(first) == 0:
            return np.empty(0, np.int64)
        starts, ends = self.span(first, last)
        whole, blake = self.data.tobytes(), hashlib.blake2b
        return np.frombuffer(b"".join([blake(whole[a:b], digest_size=8, key=key).digest()
                                       for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]), np.int64)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the smallest value in every stretch of ``width`` values, by all but its lowest 31 bits; ties:
    the leftmost. How many bits count never depends on the batch, so equal windows choose alike in any."""
    low = np.uint64((1 << 31) - 1)  # the place takes the lowest bits
    best, size = (values & ~low) | np.arange(len(values), dtype=np.uint64), 1
    while size < width:
        step = min(size, width - size)
        best, size = np.minimum(best[:-step], best[step:]), size + step
    return (best & low).astype(np.int64)


def window_runs(s: Symbols, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, first window, number of windows, anchor hash, joined) of every run; positions in the batch."""
    total = int(s.bounds[-1])
    none = np.empty(0, np.int64)
    if total < window:
        return none, none, none, none.astype(np.uint64), none.astype(bool)
    at = np.arange(total - gram + 1)
    grams = s.hashes(at, at + gram)
    anchor = sliding_least(grams, window - gram + 1)
    # A window counts if it starts and ends in one text.
    fits = np.zeros(total + 1, np.int8)
    long = np.diff(s.bounds) >= window
    np.add.at(fits, s.bounds[:-1][long], 1)
    np.add.at(fits, s.bounds[1:][long] - window + 1, -1)
    begin = np.flatnonzero(np.cumsum(fits[:len(anchor)]) > 0)
    if len(begin) == 0:
        return none, none, none, none.astype(np.uint64), none.astype(bool)
    chosen = anchor[begin]
    new = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
    first, n, gram_of = begin[new], np.diff(np.append(new, len(begin))), grams[chosen[new]]
    first, n, gram_of, joined = _periods_joined(s, window, first, n, gram_of)
    return np.searchsorted(s.bounds, first, "right") - 1, first, n, gram_of, joined


def _periods_joined(s: Symbols, window: int, first: np.ndarray, n: np.ndarray, anchor: np.ndarray):
    """Runs in which a text repeats itself at once, joined up to PERIOD_WINDOWS windows.

    Text with a short period has an equal anchor in every period: a run of a few windows each time, all
    with one stretch. They keep their anchor, so equal windows still meet; the last array tells which
    runs were joined, as only those repeat windows of their own.
    """
    stretch = s.hashes(first, first + n - 1 + window)
    again = np.r_[False, (anchor[1:] == anchor[:-1]) & (stretch[1:] == stretch[:-1]) & (first[1:] == first[:-1] + n[:-1])]
    if not again.any():
        return first, n, anchor, again
    index = np.arange(len(first))
    since = index - np.maximum.accumulate(np.where(again, 0, index))
    head = np.flatnonzero(since % np.maximum(1, PERIOD_WINDOWS // n) == 0)
    windows = np.add.reduceat(n, head)
    return first[head], windows, anchor[head], windows > n[head]


def run_rows(docs: DataFrame, window: int, gram: int, by_word: bool) -> DataFrame:
    """doc_id, tid, start, n (windows), anchor, stretch, joined: a row per run."""
    small_batches(docs.sparkSession)
    key = secrets.token_bytes(16)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches, "text", 2 << 20 if by_word else 1 << 20):
            s = Symbols(batch.column("text"), by_word)
            text, first, n, anchor, joined = window_runs(s, window, gram)
            if len(first):
                stretch = s.digests(first, first + n - 1 + window, key)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(text)), batch.column("tid").take(pa.array(text)),
                     pa.array((first - s.bounds[text]).astype(np.int32)), pa.array(n.astype(np.int32)),
                     pa.array(anchor.view(np.int64)), pa.array(stretch), pa.array(joined)],
                    ["doc_id", "tid", "start", "n", "anchor", "stretch", "joined"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_id(F.col("text")).alias("tid"), "text").mapInArrow(
        scan, f"doc_id {kind}, tid long, start int, n int, anchor long, stretch long, joined boolean")


def marked_runs(docs: DataFrame, window: int, gram: int, by_word: bool, same_doc: bool) -> DataFrame:
    """doc_id, tid, runs: array<struct<start, n, anchor, rivals>> of the runs that matter.

    A document is a doc_id and a text: rows that repeat both are one, rows that share a doc_id alone are not
    earlier than each other.

    rivals 0: a repeat as a whole of an earlier stretch. Otherwise the number of rival stretches of its
    anchor. ``same_doc``: an earlier place in the same document counts as earlier, so a joined run matters
    even if no other stretch has its anchor.
    """
    rows = run_rows(docs, window, gram, by_word)
    ordered = Window.partitionBy("anchor", "stretch").orderBy("doc_id", "tid", "start")
    of_doc = Window.partitionBy("anchor", "stretch", "doc_id", "tid").orderBy("start")
    of_anchor = Window.partitionBy("anchor")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    later = ~F.col("doc_id").eqNullSafe(F.first("doc_id").over(ordered))  # the first is the smallest, a null before all
    if same_doc:
        later = later | (F.col("start") > F.first("start").over(of_doc))
    # One exchange by anchor serves all windows.
    ranked = (rows.repartition(parts, "anchor").withColumn("later", later)
              .withColumn("texts", (F.min("stretch").over(of_anchor) != F.max("stretch").over(of_anchor)))
              .withColumn("rivals", F.sum((~F.col("later")).cast("int")).over(of_anchor).cast("int")))
    keep = ranked.filter("later OR texts" + (" OR joined" if same_doc else "")).withColumn("rivals", F.when(F.col("later"), 0).otherwise(F.col("rivals")))
    return materialize(keep.groupBy("doc_id", "tid").agg(F.collect_list(F.struct("start", "n", "anchor", "rivals")).alias("runs")), "runs")


def _with_runs(docs: DataFrame, runs: DataFrame, which) -> DataFrame:
    some = runs.select(F.col("doc_id").alias("_d"), F.col("tid").alias("_t"), F.filter("runs", which).alias("runs")).filter(F.size("runs") > 0)
    return join_by_doc(docs, some, "inner").drop("_d", "_t")


def join_by_doc(docs: DataFrame, some: DataFrame, how: str) -> DataFrame:
    """doc_id, tid and text of docs with what ``some`` (_d, _t, ...) has for them.

    A merge join at every size: what is known of the documents grows with them.
    """
    rows = docs.select("doc_id", text_id(F.col("text")).alias("tid"), "text")
    return rows.join(some.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("tid") == F.col("_t")), how)


def _runs_of(batch: pa.RecordBatch, s: Symbols, window: int) -> tuple[np.ndarray, ...]:
    """(text, position in the batch, windows, anchor) of a batch's listed runs that fit their text."""
    lists = batch.column("runs")
    flat = lists.flatten()
    text = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    first = flat.field("start").to_numpy().astype(np.int64) + s.bounds[text]
    n = flat.field("n").to_numpy().astype(np.int64)
    fits = first + n - 1 + window <= s.bounds[text + 1]
    return text[fits], first[fits], n[fits], flat.field("anchor").to_numpy()[fits]


def rival_spans(docs: DataFrame, runs: DataFrame, window: int, by_word: bool, block: Callable) -> DataFrame:
    """doc_id, tid, start, end of what ``block`` finds in blocks of rival stretches.

    ``block`` gets lists of one block: rank of the doc_id, number of the document, start, n and bytes. It
    returns three lists: the row that a span lies in, and the span's first symbol and end in the row.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rivals = lambda r: (r["rivals"] > 0) & (r["rivals"] <= MAX_RIVALS)
    size = runs.select(F.explode(F.filter("runs", rivals)).alias("r")).agg(
        F.sum((F.col("r.n") + window) * (6 if by_word else 1))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches, "text", 1 << 20):
            s = Symbols(batch.column("text"), by_word)
            text, first, n, anchor = _runs_of(batch, s, window)
            a, b = s.span(first, first + n - 1 + window) if len(first) else (first, first)
            whole = s.data.tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor % blocks), batch.column("doc_id").take(pa.array(text)), batch.column("tid").take(pa.array(text)),
                 pa.array((first - s.bounds[text]).astype(np.int32)), pa.array(n.astype(np.int32)),
                 pa.array([whole[x:y] for x, y in zip(a.tolist(), b.tolist(), strict=True)], pa.binary())],
                ["block", "doc_id", "tid", "start", "n", "bytes"])

    def compare(rows: pa.Table) -> pa.Table:
        # Earlier documents first; a null id is the earliest.
        by = [("doc_id", "ascending"), ("tid", "ascending"), ("start", "ascending")]
        rows = rows.sort_by(by) if not rows.column("doc_id").null_count else \
            pa.concat_tables([rows.filter(pc.is_null(rows["doc_id"])).sort_by(by), rows.filter(pc.is_valid(rows["doc_id"])).sort_by(by)])
        ids, tids = rows.column("doc_id").combine_chunks(), rows.column("tid").combine_chunks()
        rank = pc.rank(ids, sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy().astype(np.int64)
        document = np.cumsum(np.r_[True, (rank[1:] != rank[:-1]) | (np.diff(tids.to_numpy()) != 0)])
        start = rows.column("start").to_numpy().astype(np.int64)
        row, first, last = block(rank, document, start, rows.column("n").to_numpy().astype(np.int64), rows.column("bytes").combine_chunks())
        return pa.table([ids.take(pa.array(row)), tids.take(pa.array(row)), pa.array(start[row] + first), pa.array(start[row] + last)],
                        ["doc_id", "tid", "start", "end"])

    cut_rows = _with_runs(docs, runs, rivals).mapInArrow(cut, f"block long, doc_id {kind}, tid long, start int, n int, bytes binary")
    return cut_rows.groupBy("block").applyInArrow(compare, f"doc_id {kind}, tid long, start long, end long")


def crowded_spans(docs: DataFrame, runs: DataFrame, window: int, by_word: bool, same_doc: bool) -> DataFrame:
    """doc_id, tid, start, end of the repeated windows of anchors with more than MAX_RIVALS rivals."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    key = secrets.token_bytes(16)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches, "text", 1 << 20):
            s = Symbols(batch.column("text"), by_word)
            text, first, n, _ = _runs_of(batch, s, window)
            at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
            text = np.repeat(text, n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(s.digests(at, at + window, key)), batch.column("doc_id").take(pa.array(text)), batch.column("tid").take(pa.array(text)),
                 pa.array(at - s.bounds[text])], ["h", "doc_id", "tid", "start"])

    # Not written: in one plan with the other joins by document, the texts are shuffled once for all.
    windows = (_with_runs(docs, runs, lambda r: r["rivals"] > MAX_RIVALS)
               .mapInArrow(each, f"h long, doc_id {kind}, tid long, start long"))
    firsts = (windows.groupBy("h").agg(F.min(F.struct("doc_id")).alias("first"), F.count("*").alias("c"))
              .filter("c > 1").drop("c"))
    later = ~F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
    found = windows.join(firsts, "h")
    if same_doc:
        # Repeats inside one document: all places of a window but its first.
        found = found.withColumn("own_first", F.min("start").over(Window.partitionBy("h", "doc_id", "tid")))
        later = later | (F.col("start") > F.col("own_first"))
    return found.filter(later).select("doc_id", "tid", "start", (F.col("start") + window).alias("end"))


def repeated_spans(docs: DataFrame, window: int, gram: int, by_word: bool, same_doc: bool, block: Callable) -> DataFrame:
    """doc_id, tid, spans: array<struct<start, end>> of every symbol inside a repeated window, per document."""
    runs = marked_runs(docs, window, gram, by_word, same_doc)
    run = F.explode("runs").alias("r")
    spans = (runs.select("doc_id", "tid", run).filter("r.rivals = 0")
             .select("doc_id", "tid", F.col("r.start").cast("long").alias("start"), (F.col("r.start") + F.col("r.n") - 1 + window).cast("long").alias("end")))
    spans = spans.union(rival_spans(docs, runs, window, by_word, block))
    if not runs.filter(F.exists("runs", lambda r: r["rivals"] > MAX_RIVALS)).isEmpty():
        spans = spans.union(crowded_spans(docs, runs, window, by_word, same_doc))
    return spans.groupBy("doc_id", "tid").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
