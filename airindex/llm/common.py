"""Helpers shared by the corpus operators: word rules, scratch tables, byte hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import airindex.llm
from airindex.session import scratch_path

# Task functions travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(airindex.llm)

#: A word: any run of characters other than space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of an Arrow batch handed to Python: long texts must not pile up in one batch.
BATCH_ROWS = 256
#: Narrow rows (a few numbers each) of a scratch file, where their number is known.
ROWS_PER_FILE = 4000
_ODD = 0x9E3779B97F4A7C15  # odd multiplier of the polynomial hash modulo 2**64
_MASK = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of an Arrow batch (read when the plan runs, so it stays set)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) not in range(1, BATCH_ROWS + 1):
        spark.conf.set(key, str(BATCH_ROWS))


def materialize(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Cuts lineage with files every executor can reach, so a lost executor costs a reread. ``rows``: at
    most so many narrow rows; a small table is written in a few files, not one per shuffle partition.
    """
    path = scratch_path(df.sparkSession, name)
    if rows is not None:
        parts = rows // ROWS_PER_FILE + 1
        df = df.coalesce(parts) if parts < int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z only. ``lower`` does just that on pure ASCII; the rest is translated."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def line_key(line: Column) -> Column:
    """A line stripped of blanks at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def packed(docs: DataFrame) -> DataFrame:
    """row (all columns of docs), doc_id, tid, text: whatever docs' other columns are called."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id",
                       text_id(F.col("text")).alias("tid"), "text")


def unpacked(rows: DataFrame, columns: list[str], changed: Column, text: Column) -> DataFrame:
    """``columns`` of the packed rows; where ``changed``, with another text and n_chars in step."""
    kind = {f.name: f.dataType for f in rows.schema["row"].dataType}
    new = {"text": text} | ({"n_chars": F.char_length(text).cast(kind["n_chars"])} if "n_chars" in kind else {})
    return rows.select(*[
        (F.when(changed, new[c]).otherwise(F.col("row")[c]) if c in new else F.col("row")[c]).alias(c) for c in columns])


def text_id(text: Column) -> Column:
    """Tells apart rows that repeat a doc_id with another text."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


# -- bytes and hashes inside Arrow tasks -------------------------------------------------

def regroup(batches: Iterator[pa.RecordBatch], columns: str | tuple[str, ...], limit: int = 3 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of the columns together (one long text stays whole)."""
    held: list[pa.RecordBatch] = []
    size = 0
    names = (columns,) if isinstance(columns, str) else columns
    for batch in batches:
        first = 0
        if batch.num_rows == 0:
            continue
        ends = np.zeros(batch.num_rows + 1, np.int64)
        for name in names:
            texts = batch.column(name).cast(pa.large_binary()).fill_null(b"")
            ends += np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
        while first < batch.num_rows:
            last = int(np.searchsorted(ends, ends[first] + limit - size, "right")) - 1
            last = min(max(last, first if held else first + 1), batch.num_rows)
            if last > first:
                held.append(batch.slice(first, last - first))
                size += int(ends[last] - ends[first])
            if last < batch.num_rows or size >= limit:
                yield pa.concat_batches(held)
                held, size = [], 0
            first = last
    if held:
        yield pa.concat_batches(held)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a column of texts; null = empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    if len(texts) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.empty(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def plain_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts with one space between words, start and end of every word, and the first
    word of each text (and their number). bytes.split() knows exactly the blanks of ``WORD``."""
    rows = [b" ".join(t.split()) for t in texts.cast(pa.large_binary()).fill_null(b"").to_pylist()]
    data = np.frombuffer(b" ".join(rows), np.uint8)
    begins = np.concatenate([[0], np.cumsum([len(r) + 1 for r in rows])]) if rows else np.zeros(1, np.int64)
    starts, ends = runs(data != 0x20, np.zeros(0, np.int64)) if len(data) else (np.empty(0, np.int64),) * 2
    return data, starts, ends, np.searchsorted(starts, begins)


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true bytes; a run ends where its text does."""
    first = mask.copy()
    first[1:] &= ~mask[:-1]
    last = mask.copy()
    last[:-1] &= ~mask[1:]
    inner = offsets[(offsets > 0) & (offsets < len(mask))]
    first[inner] |= mask[inner]
    last[inner - 1] |= mask[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


_powers: dict[str, np.ndarray] = {}


def _power_table(n: int, inverse: bool) -> np.ndarray:
    key = "inverse" if inverse else "power"
    if key not in _powers or len(_powers[key]) < n:
        base = pow(_ODD, -1, 1 << 64) if inverse else _ODD
        size = max(n, 1 << 16)
        out = np.full(size, base, np.uint64)
        out[0] = 1
        _powers[key] = np.multiply.accumulate(out)
    return _powers[key][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer: spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class ByteHash:
    """Hashes of any byte ranges of ``data``: a prefix polynomial modulo 2**64, then ``mix``."""

    def __init__(self, data: np.ndarray) -> None:
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power_table(len(data), False),
                  out=self.prefix[1:])
        self.inverse = _power_table(len(data) + 1, True)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.prefix[ends] - self.prefix[starts]) * self.inverse[starts]
                   + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


PRIME = (1 << 61) - 1
_MERSENNE = np.uint64(PRIME)
#: Bases of the hash modulo 2**61 - 1; another one where words of a vocabulary collide.
BASES = tuple(pow(37, k, PRIME) for k in (1009, 2003, 3001, 4001, 5003))
_prime_powers: dict[tuple[int, bool], np.ndarray] = {}


def _folded(x: np.ndarray) -> np.ndarray:
    """x modulo 2**61 - 1, for any 64 bits."""
    x = (x & _MERSENNE) + (x >> np.uint64(61))
    return np.where(x >= _MERSENNE, x - _MERSENNE, x)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product modulo 2**61 - 1 of numbers below it."""
    half, low = np.uint64(31), np.uint64((1 << 31) - 1)
    a1, a0, b1, b0 = a >> half, a & low, b >> half, b & low
    middle = a1 * b0 + a0 * b1
    return _folded(((a1 * b1) << np.uint64(1)) + (middle >> np.uint64(30)) + ((middle & np.uint64((1 << 30) - 1)) << half)
                   + _folded(a0 * b0))


def _prime_table(n: int, base: int, inverse: bool) -> np.ndarray:
    key = (base, inverse)
    if key not in _prime_powers or len(_prime_powers[key]) < n:
        step = pow(base, -1, PRIME) if inverse else base
        out = np.ones(1, np.uint64)
        while len(out) < max(n, 1 << 16):
            out = np.concatenate([out, _times(out, np.full(len(out), pow(step, len(out), PRIME), np.uint64))])
        _prime_powers[key] = out
    return _prime_powers[key][:n]


class PrimeHash:
    """Hashes of any byte ranges of ``data``: a prefix polynomial modulo the prime 2**61 - 1, then ``mix``.

    Dearer than ``ByteHash``, but no texts are known to collide by their shape alone. Computed in short
    pieces, so that what is held besides the prefix stays small.
    """

    PIECE = 1 << 17

    def __init__(self, data: np.ndarray, base: int = BASES[0]) -> None:
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        self.inverse = _prime_table(len(data) + 1, base, True)
        powers = _prime_table(len(data), base, False)
        for a in range(0, len(data), self.PIECE):
            symbol, power = data[a: a + self.PIECE].astype(np.uint64) + np.uint64(1), powers[a: a + self.PIECE]
            high = symbol * (power >> np.uint64(32))  # times 2**32, modulo the prime
            term = _folded((high >> np.uint64(29)) + ((high & np.uint64((1 << 29) - 1)) << np.uint64(32))
                           + _folded(symbol * (power & np.uint64((1 << 32) - 1))))
            # Sums of a piece's 31-bit halves stay far below 2**64.
            top, rest = np.cumsum(term >> np.uint64(31)), np.cumsum(term & np.uint64((1 << 31) - 1))
            self.prefix[a + 1: a + 1 + len(term)] = _folded(
                (top >> np.uint64(30)) + ((top & np.uint64((1 << 30) - 1)) << np.uint64(31)) + _folded(rest) + self.prefix[a])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.empty(len(starts), np.uint64)
        for a in range(0, len(starts), self.PIECE):
            s, e = starts[a: a + self.PIECE], ends[a: a + self.PIECE]
            part = _times(_folded(self.prefix[e] + (_MERSENNE - self.prefix[s])), self.inverse[s])
            out[a: a + self.PIECE] = mix(part + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        return out


def merge_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open spans as sorted, disjoint, non-touching spans."""
    if len(starts) == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    order = np.argsort(starts, kind="stable")
    starts, ends = np.asarray(starts, np.int64)[order], np.maximum.accumulate(np.asarray(ends, np.int64)[order])
    new = np.r_[True, starts[1:] > ends[:-1]]
    last = np.r_[np.flatnonzero(new)[1:] - 1, len(starts) - 1]
    return starts[new], ends[last]
