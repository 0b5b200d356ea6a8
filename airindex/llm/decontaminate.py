"""Benchmark decontamination (operator 4): an FM-index per training shard.

A shard is a few megabytes of documents inside one task. Its words become symbols of the
benchmark's vocabulary; a word that no benchmark item has cannot be part of a match, so only the
stretches of benchmark words between such words are indexed, and no match is lost. Over them: suffix
array, Burrows-Wheeler transform, a wavelet matrix for ranks, and sampled suffix positions. All test
phrases are searched backward at once, their occurrences located by walking to a sampled position,
and the hit words merged into removal spans. Documents never move.

The test phrases are the ``window``-word windows of the items (a shorter item is one phrase). They
are shipped to the tasks in blocks of items of at most ``block_bytes`` of text; each block is searched
in all documents, and the blocks' spans are merged, so a benchmark of any size works.

Nulls: a null text has no words, a null item no phrases; an item without an id marks words but is
not listed; repeated items and repeated documents are allowed; doc_id passes through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airindex.llm.common import BASES, PrimeHash, materialize, merge_spans, packed, regroup, runs, small_batches, text_bytes, unpacked

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
#: Word bytes: 0-9, a-z and every byte of a character beyond ASCII.
_IN_WORD = np.zeros(256, bool)
_IN_WORD[0x30:0x3A] = _IN_WORD[0x61:0x7B] = _IN_WORD[0x80:] = True
SAMPLE = 16


def words(texts: pa.Array, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes; hash, start and end byte of every word; the first word of each text (and their number)."""
    data, offsets = text_bytes(texts)
    data = _LOWER[data]
    starts, ends = runs(_IN_WORD[data], offsets)
    return data, PrimeHash(data, base)(starts, ends), starts, ends, np.searchsorted(starts, offsets)


def same_bytes(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether a[a_at : a_at + length] equals b[b_at : b_at + length], pair by pair (lengths of 1 and more)."""
    if len(lengths) == 0:
        return np.empty(0, bool)
    first = np.cumsum(lengths) - lengths
    inside = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    return np.logical_and.reduceat(a[np.repeat(a_at, lengths) + inside] == b[np.repeat(b_at, lengths) + inside], first)


class Phrases:
    """The distinct test phrases of some items as rows of vocabulary symbols (1, 2, ...)."""

    def __init__(self, ids: list, texts: list, window: int) -> None:
        for self.base in BASES:
            data, hashes, starts, ends, bounds = words(pa.array(texts, pa.string()), self.base)
            self.vocabulary, one, of = np.unique(hashes, return_index=True, return_inverse=True)
            # The words' own bytes, for the comparison; another base if two words have one hash.
            self.data, self.at, self.size = data, starts[one], (ends - starts)[one]
            if (self.size[of] == ends - starts).all() and same_bytes(data, starts, data, self.at[of], ends - starts).all():
                break
        else:
            raise ValueError("words of the benchmark collide under every base")
        symbols = np.searchsorted(self.vocabulary, hashes) + 1
        found: dict[tuple, set] = {}
        for item, a, b in zip(ids, bounds[:-1], bounds[1:], strict=True):
            row = symbols[a:b].tolist()
            for p in range(max(1, len(row) - window + 1) if row else 0):
                found.setdefault(tuple(row[p: p + window]), set()).update([] if item is None else [str(item)])
        self.items = list(found.values())
        self.lengths = np.array([len(p) for p in found], np.int64)
        self.rows = np.zeros((len(found), window), np.int64)
        for i, p in enumerate(found):
            self.rows[i, window - len(p):] = p
        # Direct lookup by the upper hash bits; the few words that share a slot are compared below.
        self.bits = max(8, int(len(self.vocabulary) * 8).bit_length())
        self.slot = np.zeros(1 << self.bits, bool)
        self.slot[self.vocabulary >> np.uint64(64 - self.bits)] = True

    @classmethod
    def from_parts(cls, parts: dict) -> Phrases:
        """From the plain arrays that are broadcast."""
        self = cls.__new__(cls)
        self.__dict__.update(parts)
        return self

    def symbols(self, data: np.ndarray, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Vocabulary symbols of words, compared byte by byte; 0 for words that no item has."""
        out = np.zeros(len(hashes), np.int64)
        if len(self.vocabulary):
            maybe = np.flatnonzero(self.slot[hashes >> np.uint64(64 - self.bits)])
            at = np.minimum(np.searchsorted(self.vocabulary, hashes[maybe]), len(self.vocabulary) - 1)
            same = (self.vocabulary[at] == hashes[maybe]) & (self.size[at] == (ends - starts)[maybe])
            maybe, at = maybe[same], at[same]
            same = same_bytes(data, starts[maybe], self.data, self.at[at], self.size[at])
            out[maybe[same]] = at[same] + 1
        return out


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes of ``text`` in order; every 0 is a separator, and separators differ by position."""
    n = len(text)
    separators = text == 0
    rank = np.where(separators, np.cumsum(separators) - 1, text + int(separators.sum()))
    step = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: n - step] = rank[step:] + 1
        key = rank * (int(rank.max()) + 2) + after
        order = np.argsort(key, kind="stable")
        new = np.r_[False, key[order][1:] != key[order][:-1]]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        step *= 2
        if rank.max() == n - 1 or step >= n:
            return order


class FmIndex:
    """Backward search and locate over one shard's text of symbols and separators (0)."""

    def __init__(self, text: np.ndarray, top: int) -> None:
        order = suffix_array(text)
        self.n = len(text)
        self.bwt = text[order - 1]  # position -1 is the closing separator
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 1))])
        # Positions are sampled regularly and after each separator, which no walk crosses.
        self.sampled = (order % SAMPLE == 0) | (self.bwt == 0)
        self.position = order[self.sampled]
        self.sample = np.cumsum(self.sampled) - 1  # rank among the sampled entries
        self.levels = []
        row = self.bwt
        zero_at = np.zeros(top + 1, np.int64)
        symbol = np.arange(top + 1)
        for level in reversed(range(max(1, int(top).bit_length()))):
            bit = (row >> level) & 1
            ones = np.concatenate([[0], np.cumsum(bit)])
            zeros = self.n - int(ones[-1])
            self.levels.append((level, ones, zeros))
            zero_at = np.where((symbol >> level) & 1, zeros + ones[zero_at], zero_at - ones[zero_at])
            row = np.concatenate([row[bit == 0], row[bit == 1]])
        self.zero_at = zero_at

    def rank(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol in the first ``upto`` entries of the transform."""
        for level, ones, zeros in self.levels:
            upto = np.where((symbol >> level) & 1, zeros + ones[upto], upto - ones[upto])
        return upto - self.zero_at[symbol]

    def search(self, rows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases that occur, with the range of their suffixes."""
        phrase = np.arange(len(rows))
        low, high = np.zeros(len(rows), np.int64), np.full(len(rows), self.n, np.int64)
        for back in range(1, rows.shape[1] + 1):
            busy = np.flatnonzero(lengths[phrase] >= back)
            if len(busy) == 0:
                break
            symbol = rows[phrase[busy], -back]
            low[busy] = self.before[symbol] + self.rank(symbol, low[busy])
            high[busy] = self.before[symbol] + self.rank(symbol, high[busy])
            some = low < high
            phrase, low, high = phrase[some], low[some], high[some]
        return phrase, low, high

    def locate(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the range, text position) of every occurrence."""
        sizes = high - low
        which = np.repeat(np.arange(len(low)), sizes)
        at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(low, sizes)
        steps = np.zeros(len(at), np.int64)
        walking = np.flatnonzero(~self.sampled[at])
        while len(walking):
            symbol = self.bwt[at[walking]]
            at[walking] = self.before[symbol] + self.rank(symbol, at[walking])
            steps[walking] += 1
            walking = walking[~self.sampled[at[walking]]]
        return which, self.position[self.sample[at]] + steps


def find(texts: pa.Array, phrases: Phrases) -> dict:
    """Hits of a shard's texts: words per text, merged hit spans (words and bytes), items per text."""
    data, hashes, starts, ends, bounds = words(texts, phrases.base)
    n = len(texts)
    empty = {"n_words": np.diff(bounds), "text": np.empty(0, np.int64), "first": np.empty(0, np.int64),
             "last": np.empty(0, np.int64), "starts": starts, "ends": ends, "bounds": bounds, "items": [()] * n}
    if len(phrases.rows) == 0 or len(hashes) == 0:
        return empty
    symbols = phrases.symbols(data, hashes, starts, ends)
    a, b = runs(symbols > 0, bounds)
    long_enough = b - a >= phrases.lengths.min()
    a, b = a[long_enough], b[long_enough]
    if len(a) == 0:
        return empty
    # Stretches one after another, a separator after each; at[i]: the word that text position i is.
    size = b - a + 1
    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(a, size)
    text = symbols[np.minimum(at, len(symbols) - 1)]
    text[np.cumsum(size) - 1] = 0
    index = FmIndex(text, len(phrases.vocabulary))
    phrase, low, high = index.search(phrases.rows, phrases.lengths)
    which, position = index.locate(low, high)
    word = at[position]
    first, last = merge_spans(word, word + phrases.lengths[phrase[which]])
    # Touching spans of two texts were merged: cut them at the texts' bounds.
    marks = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(marks, first, 1)
    np.add.at(marks, last, -1)
    first, last = runs(np.cumsum(marks[:-1]) > 0, bounds)
    text_of = np.searchsorted(bounds, word, "right") - 1
    items: list[set] = [set() for _ in range(n)]
    pairs = np.unique(text_of * len(phrases.rows) + phrase[which])
    for pair in pairs.tolist():
        items[pair // len(phrases.rows)].update(phrases.items[pair % len(phrases.rows)])
    return empty | {"text": np.searchsorted(bounds, first, "right") - 1, "first": first, "last": last,
                    "items": [sorted(x) for x in items]}


def _span_lists(hits: dict, offsets: np.ndarray, n: int) -> list[list[dict]]:
    out: list[list[dict]] = [[] for _ in range(n)]
    for t, f, l in zip(hits["text"].tolist(), hits["first"].tolist(), hits["last"].tolist(), strict=True):
        out[t].append({"start": int(hits["starts"][f] - offsets[t]), "end": int(hits["ends"][l - 1] - offsets[t]), "words": l - f,
                       "first": int(f - hits["bounds"][t])})
    return out


SPANS = "array<struct<start:long,end:long,words:long,first:long>>"
_SPAN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("words", pa.int64()), ("first", pa.int64())]))


def item_blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[tuple[list, list]]:
    """The benchmark's items in blocks of bounded size, one at a time on the driver."""
    ids, texts, size = [], [], 0
    for row in benchmark.select("item_id", "text").filter(F.col("text").isNotNull()).toLocalIterator():
        ids.append(row[0])
        texts.append(row[1])
        size += len(row[1].encode())
        if size >= block_bytes:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10,
                       block_bytes: int = 16 << 20) -> DataFrame:
    """Adds n_words, spans (bytes and words of the hit runs) and items to the rows of docs."""
    small_batches(docs.sparkSession)
    parts = []
    for ids, texts in item_blocks(benchmark, block_bytes):
        parts.append(_search(docs, Phrases(ids, texts, window)))
        if len(parts) > 1:
            parts[-1] = materialize(parts[-1], "hits")
    if not parts:
        parts = [_search(docs, Phrases([], [], window))]
    if len(parts) == 1:
        return parts[0]
    return _merge_blocks(parts, docs.columns)


def _search(docs: DataFrame, phrases: Phrases) -> DataFrame:
    shipped = docs.sparkSession.sparkContext.broadcast(vars(phrases))  # block_bytes bounds it

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Phrases.from_parts(shipped.value)
        for batch in regroup(batches, "text"):
            hits = find(batch.column("text"), phrases)
            offsets = text_bytes(batch.column("text"))[1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(hits["n_words"], pa.int64()),
                 pa.array(_span_lists(hits, offsets, batch.num_rows), _SPAN_TYPE),
                 pa.array([list(x) for x in hits["items"]], pa.list_(pa.string()))],
                [*batch.schema.names, "n_words", "spans", "items"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(scan, f"{fields}, n_words long, spans {SPANS}, items array<string>")


def _merge_blocks(parts: list[DataFrame], columns: list[str]) -> DataFrame:
    """One row per row of docs from the rows that each block of items gave."""
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    merged = every.groupBy(*columns).agg(
        (F.count("*") / len(parts)).cast("int").alias("_rows"), F.first("n_words").alias("n_words"),
        F.sort_array(F.flatten(F.collect_list(F.transform("spans", lambda s: F.struct(
            s["first"].alias("first"), s["words"].alias("words"), s["start"].alias("start"), s["end"].alias("end")))))).alias("_spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    # Spans of several blocks may overlap or touch: fold them in order of their first word.
    def fold(done, s):
        last = F.element_at(done, -1)
        reach = F.greatest(last["first"] + last["words"], s["first"] + s["words"])
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"),
                          (reach - last["first"]).alias("words"), last["first"].alias("first"))
        alone = F.struct(s["start"].alias("start"), s["end"].alias("end"), s["words"].alias("words"), s["first"].alias("first"))
        return F.when((F.size(done) > 0) & (s["first"] <= F.get(done, F.size(done) - 1)["first"] + F.get(done, F.size(done) - 1)["words"]),
                      F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(F.concat(done, F.array(alone)))
    spans = F.aggregate("_spans", F.array().cast(SPANS), fold)
    return (merged.withColumn("spans", spans).withColumn("_copy", F.explode(F.expr("sequence(1, _rows)")))
            .select(*columns, "n_words", "spans", "items"))


def cut_spans(found: DataFrame) -> DataFrame:
    """found with ``clean``: the text without its spans (null where there is none)."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                if not spans:
                    clean.append(None)
                    continue
                data, pieces, at = text.encode(), [], 0
                for s in spans:
                    pieces.append(data[at: s["start"]])
                    at = s["end"]
                clean.append(b"".join([*pieces, data[at:]]).decode())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(clean, pa.string())], [*batch.schema.names, "clean"])

    return found.mapInArrow(cut, f"{fields}, clean string")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """docs with every span of benchmark windows cut out of the texts."""
    found = cut_spans(find_contamination(packed(docs).select("row", "text"), benchmark, window))
    return unpacked(found, docs.columns, F.col("clean").isNotNull(), F.col("clean"))


def op4(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = find_contamination(docs.select("doc_id", "text"), benchmark)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["words"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


SQL = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS (SELECT DISTINCT item_id, n, array_to_string(ws[p:p + n - 1], ' ') AS phrase FROM
    (SELECT item_id, ws, least(10, len(ws)) AS n, unnest(range(1, greatest(1, len(ws) - 9) + 1)) AS p FROM bw WHERE len(ws) > 0)),
lens AS (SELECT DISTINCT n FROM win),
dwin AS (SELECT doc_id, p, n, array_to_string(ws[p:p + n - 1], ' ') AS phrase FROM
    (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS p FROM dw, lens WHERE len(ws) >= n)),
occ AS (SELECT doc_id, p, n, item_id FROM dwin JOIN win USING (n, phrase)),
hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM occ) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items FROM
    (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM occ WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""
