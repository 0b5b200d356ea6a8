"""Quality classifier (operator 9): positive-unlabelled learning with a non-negative risk.

Every whole text becomes a short vector of features (shares of byte classes, word and line shapes,
repetition, and which words it uses: the share of its words in each of ``BUCKETS`` hash buckets). Trusted positives are labelled rows of the training folds; all rows of those folds, whatever
their label, are the unlabelled text: a mixture of positives, at an estimated class prior, and negatives
(so a table with a label for every row is scored, too). A small network
minimises the unbiased PU risk  prior * R+(P) + max(0, R-(U) - prior * R-(P)),  whose negative part is
kept from going below zero, as a flexible model could otherwise push it. The fit reads a bounded sample
(``sample`` positives and ``sample`` unlabelled rows, those with the smallest hashes); features and
scores cover all rows.

The class prior is estimated from the positives and the unlabelled text alone, negatives' labels are not
used anywhere: a network is taught to tell one half of the positives from one half of the unlabelled rows,
and where the scores of the other halves are high, unlabelled rows are as rare among positives as positives
are in the mixture. The prior is the least such ratio, at the threshold where it is surest (best bin).

Nulls: a null or empty text is a vector of zeros and is scored like any other; labels that are not 1 are
ignored; without positives every score is one half. doc_id passes through, null
or repeated (the fold of a null id is that of the empty string).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airindex.llm.common import ByteHash, materialize, regroup, runs, small_batches, text_bytes, text_id

#: Byte classes: lower case, upper case, digit, blank, newline, full stop or comma, other ASCII
#: punctuation, table and markup symbols, bytes beyond ASCII.
_CLASS = np.full(256, 6, np.int64)
_CLASS[0x61:0x7B], _CLASS[0x41:0x5B], _CLASS[0x30:0x3A] = 0, 1, 2
_CLASS[[0x20, 0x09, 0x0B, 0x0C, 0x0D]], _CLASS[0x0A], _CLASS[[0x2E, 0x2C]] = 3, 4, 5
_CLASS[[ord(c) for c in "#*$%&|<>"]] = 7
_CLASS[0x80:] = 8
CLASSES = 9
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 9, 10, 11, 12, 13]] = True


def _distinct(keys: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """Distinct keys per text."""
    order = np.lexsort((keys, of))
    k, t = keys[order], of[order]
    first = np.r_[True, (k[1:] != k[:-1]) | (t[1:] != t[:-1])] if len(k) else np.empty(0, bool)
    return np.bincount(t[first], minlength=n)


def features(texts: pa.Array) -> np.ndarray:
    """One row of features per text."""
    data, offsets = text_bytes(texts)
    n = len(texts)
    if n == 0:
        return np.empty((0, N_FEATURES), np.float32)
    size = np.diff(offsets)
    of_byte = np.repeat(np.arange(n), size)
    shares = np.bincount(of_byte * CLASSES + _CLASS[data], minlength=n * CLASSES).reshape(n, CLASSES)
    starts, ends = runs(~_BLANK[data], offsets) if len(data) else (np.empty(0, np.int64),) * 2
    bounds = np.searchsorted(starts, offsets)
    words = np.diff(bounds)
    of_word = np.repeat(np.arange(n), words)
    hashes = ByteHash(data)(starts, ends) if len(data) else np.empty(0, np.uint64)
    length = np.bincount(of_word, weights=(ends - starts), minlength=n)
    square = np.bincount(of_word, weights=(ends - starts) ** 2.0, minlength=n)
    capital = np.bincount(of_word, weights=(_CLASS[data[starts]] == 1) if len(starts) else None, minlength=n)
    marked = np.bincount(of_word, weights=np.isin(_CLASS[data[ends - 1]], (6, 7)) if len(ends) else None, minlength=n)
    next_same = of_word[1:] == of_word[:-1] if len(of_word) else np.empty(0, bool)
    pair = (hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ hashes[1:])[next_same] if len(hashes) else hashes
    same_word = np.bincount(of_word[1:][next_same & (hashes[1:] == hashes[:-1])], minlength=n) if len(hashes) else np.zeros(n)
    pair_of = of_word[1:][next_same] if len(of_word) else of_word
    lines = shares[:, 4] + (size > 0)
    per_byte, per_word = 1 / np.maximum(size, 1), 1 / np.maximum(words, 1)
    mean = length * per_word
    out = [shares * per_byte[:, None], np.log1p(size), np.log1p(words), mean, np.sqrt(np.maximum(square * per_word - mean ** 2, 0)),
           capital * per_word, marked * per_word, _distinct(hashes, of_word, n) * per_word,
           _distinct(pair, pair_of, n) / np.maximum(words - 1, 1), same_word * per_word, np.log1p(lines), np.log1p(words / np.maximum(lines, 1)),
           np.sqrt(np.bincount(of_word * BUCKETS + (hashes % np.uint64(BUCKETS)).astype(np.int64), minlength=n * BUCKETS).reshape(n, BUCKETS)
                   * per_word[:, None])]
    return np.column_stack(out).astype(np.float32)


BUCKETS = 64
SHAPES = CLASSES + 11
N_FEATURES = SHAPES + BUCKETS
WORD_WEIGHT = 0.2  # of the many word buckets beside the few shapes


def feature_rows(docs: DataFrame) -> DataFrame:
    """doc_id, tid, x: array<float>, a row per row of docs."""
    small_batches(docs.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches, "text", 2 << 20):
            x = features(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tid"),
                 pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), N_FEATURES).cast(pa.list_(pa.float32()))],
                ["doc_id", "tid", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_id(F.col("text")).alias("tid"), "text").mapInArrow(
        scan, f"doc_id {kind}, tid long, x array<float>")


def held_out(doc_id: Column, folds: int = 5) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == 0


class PuNetwork:
    """One hidden layer, logistic loss, trained on the non-negative PU risk by Adam."""

    def __init__(self, inputs: int, hidden: int = 24, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        self.mean, self.scale = np.zeros(inputs), np.ones(inputs)
        self.w = [rng.normal(0, inputs ** -0.5, (inputs, hidden)), np.zeros(hidden),
                  rng.normal(0, hidden ** -0.5, (hidden, 1)), np.zeros(1)]

    def _forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = np.tanh(x @ self.w[0] + self.w[1])
        return h, (h @ self.w[2] + self.w[3])[:, 0]

    def _backward(self, x: np.ndarray, h: np.ndarray, slope: np.ndarray) -> list[np.ndarray]:
        back = slope[:, None] @ self.w[2].T * (1 - h ** 2)
        return [x.T @ back, back.sum(0), h.T @ slope[:, None], np.array([slope.sum()])]

    def fit(self, positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, epochs: int = 200,
            batch: int = 512, rate: float = 5e-3, decay: float = 1e-4, seed: int = 12) -> None:
        """``prior`` None: an ordinary classifier of positive against unlabelled rows."""
        both = np.vstack([positive, unlabelled])
        self.mean, self.scale = both.mean(0), both.std(0) + 1e-6
        positive, unlabelled = self._scaled(positive), self._scaled(unlabelled)
        rng = np.random.default_rng(seed)
        first, second = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w]
        steps = max(4, min(len(unlabelled), 8192) // batch)
        t = 0
        for epoch in range(epochs):
            lr = rate * (1 - epoch / epochs) + 1e-5
            for _ in range(steps):
                p = positive[rng.integers(len(positive), size=batch)]
                u = unlabelled[rng.integers(len(unlabelled), size=batch)]
                hp, gp = self._forward(p)
                hu, gu = self._forward(u)
                sp, su = 1 / (1 + np.exp(-gp)), 1 / (1 + np.exp(-gu))
                # d/dg of log(1 + e^-g) is s - 1, of log(1 + e^g) is s.
                if prior is None:
                    slope_p, slope_u = (sp - 1) / batch, su / batch
                elif np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean() >= 0:
                    slope_p, slope_u = prior * ((sp - 1) - sp) / batch, su / batch
                else:  # step back: undo what made the negative part of the risk negative
                    slope_p, slope_u = prior * sp / batch, -su / batch
                grads = [a + b for a, b in zip(self._backward(p, hp, slope_p), self._backward(u, hu, slope_u), strict=True)]
                t += 1
                for i, g in enumerate(grads):
                    g = g + decay * self.w[i]
                    first[i] = 0.9 * first[i] + 0.1 * g
                    second[i] = 0.999 * second[i] + 0.001 * g * g
                    self.w[i] -= lr * (first[i] / (1 - 0.9 ** t)) / (np.sqrt(second[i] / (1 - 0.999 ** t)) + 1e-8)

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        out = np.clip((x - self.mean) / self.scale, -8, 8)
        out[:, SHAPES:] *= WORD_WEIGHT
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._forward(self._scaled(x))[1], -40, 40)))


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray, gamma: float = 0.01, delta: float = 0.1) -> float:
    """The share of positives in the unlabelled rows, between 0.01 and 0.99."""
    if len(positive) < 4 or len(unlabelled) < 4:
        return 0.5
    network = PuNetwork(positive.shape[1])
    network.fit(positive[::2], unlabelled[::2], None, epochs=60, decay=1e-2)
    p, u = np.sort(network.scores(positive[1::2])), np.sort(network.scores(unlabelled[1::2]))
    # Shares of both halves with a score of at least each score of a positive.
    at = np.unique(p)
    share_p = 1 - np.searchsorted(p, at) / len(p)
    share_u = 1 - np.searchsorted(u, at) / len(u)
    doubt = math.sqrt(math.log(4 / delta) / (2 * len(u))) + math.sqrt(math.log(4 / delta) / (2 * len(p)))
    best = np.argmin((share_u + (1 + gamma) * doubt) / share_p)
    return float(np.clip(share_u[best] / share_p[best], 0.01, 0.99))


def fit_classifier(rows: DataFrame, labels: DataFrame, sample: int = 20_000) -> tuple[PuNetwork | None, float]:
    """The network and the class prior, from the training folds alone."""
    known = (labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id", "quality").distinct())
    train = rows.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).join(known, "doc_id", "left")

    def draw(some: DataFrame) -> np.ndarray:
        picked = some.orderBy(F.xxhash64(F.lit(5), "doc_id", "tid"), "doc_id").limit(sample).select("x")
        table = picked.toArrow().column("x").combine_chunks()
        return np.asarray(table.flatten(), np.float64).reshape(-1, N_FEATURES)

    positive = draw(train.filter("quality = 1"))
    # The risk's mixture is of all documents, so labelled ones are in it too, their label left out.
    unlabelled = draw(train)
    if len(positive) == 0:
        return None, 0.5
    prior = estimated_prior(positive, unlabelled)
    network = PuNetwork(N_FEATURES)
    network.fit(positive, unlabelled, prior)
    return network, prior


def score_quality(docs: DataFrame, labels: DataFrame, sample: int = 20_000, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted: a row per row of docs."""
    rows = materialize(feature_rows(docs), "features")
    network, prior = fit_classifier(rows, labels, sample)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column("x").flatten(), np.float64).reshape(-1, N_FEATURES)
            s = np.full(batch.num_rows, prior) if network is None else network.scores(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                ["doc_id", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = rows.select("doc_id", "x").mapInArrow(score, f"doc_id {kind}, score double, predicted int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op9(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score_quality(docs.select("doc_id", "text"), labels.select("doc_id", "quality"))
