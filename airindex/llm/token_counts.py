"""Token counts (operator 5): byte-level BPE by rank-synchronous array merging.

Texts are cut into pre-tokens by the tokenizer file's pattern. The distinct pre-tokens of a batch
become one ragged array of symbols; in every round each sequence merges all occurrences of its own
lowest-rank pair, for all sequences at once, until no sequence has a known pair. The symbols that
survive are its tokens. A very long pre-token (a megabyte without a blank) would need a pass over all of it
per round; its rounds visit only the places around their merges. Counts are remembered per worker in a
bounded table.

Special strings inside a text (the file's added tokens) are one token each and separate what stands
around them, as the library does by default.

Nulls: a null text is empty (0 tokens); doc_id passes through, null or repeated.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from airindex.llm.common import regroup, small_batches

#: The pre-token pattern of byte-level BPE, with Unicode's white space spelled out.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
           rf"| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
NO_RANK = np.int64(1 << 40)
REMEMBERED = 500_000
LONG = 512  # bytes of a pre-token from which on a round touches its merges only


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shifted = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(shifted)}


class RankMerger:
    """Token counts of byte strings under the merges of a tokenizer file."""

    def __init__(self, path: str | None = None, content: str | None = None) -> None:
        if content is None:
            with open(path, encoding="utf-8") as f:
                content = f.read()
        spec = json.loads(content)
        vocab = spec["model"]["vocab"]
        symbols = byte_symbols()
        self.first = np.array([vocab[symbols[b]] for b in range(256)], np.int64)
        pairs = [x if isinstance(x, list) else x.split(" ") for x in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        special = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.pattern = regex.compile(PATTERN)
        self.known: dict[str, int] = {}

    def ranks(self, key: np.ndarray) -> np.ndarray:
        """Ranks of symbol pairs; NO_RANK for a pair that never merges."""
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], NO_RANK)

    def long_count(self, sequence: bytes) -> int:
        """Tokens of one long byte string: the same rounds, each touching only the symbols around its merges.

        Symbols are a linked array; a heap gives the lowest rank, a bucket per rank the places that had it.
        """
        ids = self.first[np.frombuffer(sequence, np.uint8)]
        n = len(ids)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        current = np.append(self.ranks(ids[:-1] << 32 | ids[1:]), NO_RANK)
        buckets: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def note(places: np.ndarray) -> None:
            places = places[current[places] < NO_RANK]
            places = places[np.argsort(current[places], kind="stable")]
            for part in np.split(places, np.flatnonzero(np.diff(current[places])) + 1):
                if len(part):
                    rank = int(current[part[0]])
                    if rank not in buckets:
                        buckets[rank] = []
                        heapq.heappush(heap, rank)
                    buckets[rank].append(part)

        note(np.arange(n))
        left = n
        while heap:
            rank = heapq.heappop(heap)
            spot = np.unique(np.concatenate(buckets.pop(rank)))
            spot = spot[current[spot] == rank]
            if len(spot) == 0:
                continue
            # In a run of equal symbols the pairs overlap: every other one merges, from the left.
            run = np.r_[True, after[spot[:-1]] != spot[1:]]
            since = np.arange(len(spot)) - np.maximum.accumulate(np.where(run, np.arange(len(spot)), 0))
            spot = spot[since % 2 == 0]
            gone = after[spot]
            ids[spot] = self.merged[rank]
            current[gone] = NO_RANK
            after[spot] = after[gone]
            inside = after[spot] < n
            before[after[spot][inside]] = spot[inside]
            left -= len(spot)
            near = np.unique(np.concatenate([spot, before[spot]]))
            near = near[near >= 0]
            follow = after[near]
            there = follow < n
            current[near] = NO_RANK
            current[near[there]] = self.ranks(ids[near[there]] << 32 | ids[follow[there]])
            note(near)
        return left

    def counts(self, sequences: list[bytes]) -> np.ndarray:
        """Tokens of each non-empty byte string."""
        if any(len(s) > LONG for s in sequences):
            out = np.zeros(len(sequences), np.int64)
            short = [i for i, s in enumerate(sequences) if len(s) <= LONG]
            if short:
                out[short] = self.counts([sequences[i] for i in short])
            for i, s in enumerate(sequences):
                if len(s) > LONG:
                    out[i] = self.long_count(s)
            return out
        out = np.array([len(s) for s in sequences], np.int64)
        ids = self.first[np.frombuffer(b"".join(sequences), np.uint8)]
        seq = np.repeat(np.arange(len(sequences)), out)
        while len(ids) > 1:
            rank = np.where(seq[:-1] == seq[1:], self.ranks(ids[:-1] << 32 | ids[1:]), NO_RANK)
            rank = np.append(rank, NO_RANK)
            begins = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            sizes = np.diff(np.append(begins, len(seq)))
            lowest = np.repeat(np.minimum.reduceat(rank, begins), sizes)
            # Sequences without a known pair are done.
            busy = lowest < NO_RANK
            if not busy.any():
                break
            ids, seq, rank, lowest = ids[busy], seq[busy], rank[busy], lowest[busy]
            hit = rank == lowest
            # In a run of equal symbols the pairs overlap: every other one merges, from the left.
            spot = np.flatnonzero(hit)
            run = np.r_[True, np.diff(spot) > 1]
            since = np.arange(len(spot)) - np.maximum.accumulate(np.where(run, np.arange(len(spot)), 0))
            spot = spot[since % 2 == 0]
            ids[spot] = self.merged[lowest[spot]]
            gone = np.zeros(len(ids), bool)
            gone[spot + 1] = True
            np.subtract.at(out, seq[spot], 1)
            ids, seq = ids[~gone], seq[~gone]
        return out

    def text_counts(self, texts: list[str]) -> list[int]:
        cut, extra = [], []
        for text in texts:
            pieces = self.special.split(text) if self.special else [text]
            extra.append(len(pieces) - 1)
            cut.append([t for p in pieces for t in self.pattern.findall(p)])
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = list({t for tokens in cut for t in tokens}.difference(self.known))
        if new:
            self.known.update(zip(new, self.counts([t.encode() for t in new]).tolist(), strict=True))
        known = self.known.__getitem__
        return [n + sum(map(known, tokens)) for n, tokens in zip(extra, cut, strict=True)]


_mergers: dict[str, RankMerger] = {}


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: a row per row of docs.

    ``vocabulary``: path of the tokenizer file on the driver; its content (megabytes) is sent to the tasks.
    """
    small_batches(docs.sparkSession)
    with open(vocabulary, encoding="utf-8") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _mergers:
            _mergers[vocabulary] = RankMerger(content=content.value)
        for batch in regroup(batches, "text"):
            texts = batch.column("text").fill_null("").to_pylist()
            tokens = _mergers[vocabulary].text_counts(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t.encode()) for t in texts], pa.int64()),
                 pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")


def op5(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    if vocabulary is None:
        import public_tokenizers
        vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return count_tokens(docs, str(vocabulary))
