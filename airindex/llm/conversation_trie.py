"""Conversation prefix trie (operator 11): balanced parentheses per shard, shared spines merged.

A conversation is the path of its turns; a trie node is a sequence of first turns that some conversation
starts with. Conversations are range-partitioned and sorted by path (SHA-256 digests of the turns, then
conv_id, so that a path that a third of all share is many shards'). Each stretch of about ``SHARD_TURNS``
turns is a shard: its trie is one string of parentheses, and a range min-max tree over blocks of its
excess finds where a node closes. Between the two parentheses lie the node's subtree and members: the
rank of ``()`` pairs counts leaves, cumulative arrays give members and savings.

Only nodes on a shard's first and last path (its spines) can be in other shards, too. Their parts are
summed by node; sums over a spine node's subtree then double their reach in each round, so a deep trie
takes the logarithm of its depth in rounds and no task sees all spines. Identifiers that end at a spine
node stream through one hash in order, piece by piece: one digest of one string has no shorter way.

Nulls: a null role or text is empty, a null turn comes first; a row without a conv_id belongs to no
conversation. Turns that repeat a turn number are ordered by their digest; repeated rows are repeated
turns. An empty table has no nodes, not even a root. One conversation's digests (32 bytes a turn) must fit
a row. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airindex.llm.common import materialize, n_words

SHARD_TURNS = 200_000  # turns (and conversations) of a shard: bounds a task's memory
GROUP, MOST_BORROWED, STARTS = 20, 3, 4  # the contract's rebuilding rule
SHARD_ROWS = ("kind int, shard long, key binary, parent_key binary, depth long, words long, conv_id long, parent_conv_id long, "
              "n_convs long, n_children long, n_leaves long, saved long, ends string")
COMPLETE, SPINE, PIECE = 0, 1, 2


class Parens:
    """Balanced parentheses (1 opens) with a range min-max tree over blocks of the excess."""

    BLOCK = 256

    def __init__(self, bits: np.ndarray) -> None:
        self.excess = np.cumsum(np.where(bits, 1, -1))
        blocks = -(-len(bits) // self.BLOCK)
        padded = np.full(blocks * self.BLOCK, np.iinfo(np.int64).max)
        padded[:len(bits)] = self.excess
        level = padded.reshape(blocks, self.BLOCK).min(1)
        levels = [level]
        while len(level) > 1:
            level = np.append(level, np.iinfo(np.int64).max) if len(level) % 2 else level
            levels[-1] = level
            level = level.reshape(-1, 2).min(1)
            levels.append(level)
        self.first = np.cumsum([0, *map(len, levels)])
        self.least = np.concatenate(levels)

    def _scan(self, at: np.ndarray, target: np.ndarray) -> np.ndarray:
        """The first place from ``at`` on, in its own block, with the excess at the target; -1 if none."""
        found = np.full(len(at), -1)
        left = np.arange(len(at))
        at = at.copy()
        while len(left):
            inside = at < len(self.excess)
            left, at = left[inside], at[inside]
            hit = self.excess[at] <= target[left]
            found[left[hit]] = at[hit]
            at = at + 1
            on = ~hit & (at % self.BLOCK != 0)
            left, at = left[on], at[on]
        return found

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        target = self.excess[opens] - 1
        close = np.full(len(opens), -1)
        here = (opens + 1) % self.BLOCK != 0
        close[here] = self._scan(opens[here] + 1, target[here])
        far = np.flatnonzero(close < 0)
        block = opens[far] // self.BLOCK + 1
        level = np.zeros(len(far), np.int64)
        goal = target[far]
        found = np.zeros(len(far), np.int64)
        live = np.arange(len(far))
        while len(live):
            here = self.least[self.first[level] + block] <= goal[live]
            done = here & (level == 0)
            found[live[done]] = block[done]
            # Into the first half that holds it; else on to the next block, by way of the parents.
            down = here & ~done
            up = ~here & (block % 2 == 1)
            block = np.where(down, 2 * block, np.where(up, (block + 1) // 2, block + ~here))
            level = np.where(down, level - 1, np.where(up, level + 1, level))
            live, block, level = live[~done], block[~done], level[~done]
        close[far] = self._scan(found * self.BLOCK, goal)
        return close


def range_minima(values: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """min(values[first:end]) of each non-empty range."""
    out = np.empty(len(first), values.dtype)
    power = np.frexp((end - first).astype(np.float64))[1] - 1  # the largest power of two inside
    table = values
    for p in range(int(power.max(initial=-1)) + 1):
        if p:
            half = 1 << (p - 1)
            table = np.minimum(table[:-half], table[half:])
        at = np.flatnonzero(power == p)
        out[at] = np.minimum(table[first[at]], table[end[at] - (1 << p)])
    return out


def encoded(ids: np.ndarray, lengths: np.ndarray, digests: np.ndarray, words: np.ndarray) -> dict[str, np.ndarray]:
    """The trie of conversations sorted by path (flat turns, ``lengths`` each), node by node in preorder."""
    n = len(ids)
    begin = np.cumsum(lengths) - lengths
    conv = np.repeat(np.arange(n), lengths)
    depth = np.arange(len(conv)) - begin[conv]
    before = np.maximum(conv - 1, 0)
    both = (conv > 0) & (depth < lengths[before])
    same = np.zeros(len(conv), bool)
    at = np.flatnonzero(both)
    same[at] = (digests[at] == digests[begin[before[at]] + depth[at]]).all(1)
    common = lengths.copy()  # first turns shared with the conversation before
    np.minimum.at(common, conv[~same], depth[~same])
    new = np.flatnonzero(depth >= common[conv])
    closes = np.cumsum(np.append(0, lengths[:-1] - common[1:])) if n else np.zeros(0, np.int64)
    opens = np.append(0, 1 + np.arange(len(new)) + closes[conv[new]])
    bits = np.zeros(2 * len(opens), bool)
    bits[opens] = True
    parens = Parens(bits)
    close = parens.findclose(opens)

    node_depth = np.append(0, depth[new] + 1)
    # The parent is the last earlier node one level up.
    key = node_depth * len(opens) + np.arange(len(opens))
    order = np.argsort(key)
    parent = order[np.searchsorted(key[order], (node_depth - 1) * len(opens) + np.arange(len(opens))) - 1]
    parent[0] = -1
    opened = np.bincount(conv[new], minlength=n)
    last = np.where(opened > 0, np.cumsum(opened), 0)
    ends_at = np.maximum.accumulate(last)  # a conversation that opens nothing repeats the one before

    def between(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        total = np.append(0, np.cumsum(flags))
        return total[opens], total[close + 1]

    first_conv, end_conv = between(np.bincount(opens[ends_at], minlength=len(bits)))
    first_leaf, end_leaf = between(bits & ~np.append(bits[1:], True))
    return {"opens": opens, "close": close, "depth": node_depth, "parent": parent, "ends_at": ends_at,
            "first": first_conv, "end": end_conv, "n_leaves": end_leaf - first_leaf,
            "words": np.append(0, words[new]), "turn": np.append(-1, new),
            "conv_id": range_minima(ids, first_conv, end_conv),
            "n_children": np.bincount(parent[1:], minlength=len(opens))}


def shard_rows(shard: int, ids: np.ndarray, lengths: np.ndarray, digests: np.ndarray, words: np.ndarray) -> pa.RecordBatch:
    """The finished nodes of a shard, the parts of its spine nodes, and what ends at these."""
    trie = encoded(ids, lengths, digests, words)
    count = len(trie["opens"])
    size = (trie["close"] - trie["opens"] + 1) // 2
    n_convs = trie["end"] - trie["first"]
    spine = np.zeros(count, bool)
    spine[:lengths[0] + 1] = True
    node = int(trie["ends_at"][-1])
    while node >= 0 and not spine[node]:
        spine[node] = True
        node = int(trie["parent"][node])

    def subtree(values: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(values))
        at = np.arange(count)
        return total[at + size] - total[at]

    def beside_spine(values: np.ndarray) -> np.ndarray:
        """Of a spine node's subtree, what is in no spine node's."""
        total = subtree(np.where(spine, 0, values))
        out = total.copy()
        inner = np.flatnonzero(spine)[1:]
        np.subtract.at(out, trie["parent"][inner], total[inner])
        return out

    parent = np.maximum(trie["parent"], 0)
    saved = (n_convs - 1) * trie["words"]
    whole = np.flatnonzero(~spine)
    bones = np.flatnonzero(spine)
    keys: dict[int, bytes] = {0: hashlib.sha256().digest()}
    for j in bones[1:].tolist():
        keys[j] = hashlib.sha256(keys[int(trie["parent"][j])] + digests[trie["turn"][j]].tobytes()).digest()
    begins = np.searchsorted(trie["ends_at"], np.arange(count), "left")
    stops = np.searchsorted(trie["ends_at"], np.arange(count), "right")
    nothing = hashlib.sha256().hexdigest()

    def joined(j: int) -> str:
        return ",".join(map(str, ids[begins[j]:stops[j]].tolist()))

    pieces = [j for j in bones.tolist() if stops[j] > begins[j]]
    ends = [hashlib.sha256(joined(j).encode()).hexdigest() if stops[j] > begins[j] else nothing for j in whole.tolist()]
    off_children = np.bincount(trie["parent"][whole], minlength=count) if len(whole) else np.zeros(count, np.int64)
    off_leaves, off_saved, all_saved = beside_spine(trie["n_children"] == 0), beside_spine(saved), subtree(saved)
    parents = [keys.get(int(j)) for j in trie["parent"][whole].tolist()]

    def column(kind, *parts):
        return pa.array([x for part in parts for x in (part.tolist() if isinstance(part, np.ndarray) else part)], kind)

    rows, bone, piece = len(whole), len(bones), len(pieces)
    empty = lambda n: [None] * n
    return pa.RecordBatch.from_arrays([
        column(pa.int32(), [COMPLETE] * rows, [SPINE] * bone, [PIECE] * piece),
        column(pa.int64(), [shard] * (rows + bone + piece)),
        column(pa.binary(), empty(rows), [keys[j] for j in bones.tolist()], [keys[j] for j in pieces]),
        column(pa.binary(), parents, [keys.get(int(j)) for j in trie["parent"][bones].tolist()], empty(piece)),
        column(pa.int64(), trie["depth"][whole], trie["depth"][bones], empty(piece)),
        column(pa.int64(), trie["words"][whole], trie["words"][bones], empty(piece)),
        column(pa.int64(), trie["conv_id"][whole], trie["conv_id"][bones], ids[begins[pieces]] if pieces else []),
        column(pa.int64(), trie["conv_id"][parent[whole]], empty(bone), empty(piece)),
        column(pa.int64(), n_convs[whole], n_convs[bones], empty(piece)),
        column(pa.int64(), trie["n_children"][whole], off_children[bones], empty(piece)),
        column(pa.int64(), trie["n_leaves"][whole], off_leaves[bones], empty(piece)),
        column(pa.int64(), all_saved[whole], off_saved[bones], empty(piece)),
        column(pa.string(), ends, empty(bone), [joined(j) for j in pieces]),
    ], [f.split()[0] for f in SHARD_ROWS.split(", ")])


def shards(batches: Iterator[pa.RecordBatch], limit: int = 0) -> Iterator[pa.RecordBatch]:
    """Cuts a partition's sorted conversations into shards of about ``limit`` turns."""
    limit = limit or SHARD_TURNS
    context = TaskContext.get()
    shard = (context.partitionId() if context else 0) << 32
    held: list[tuple[np.ndarray, ...]] = []
    load = 0
    for batch in batches:
        steps = batch.column("steps")
        offsets = steps.offsets.to_numpy()
        turns = steps.values.slice(offsets[0], offsets[-1] - offsets[0])
        digests = np.frombuffer(b"".join(turns.field("digest").to_pylist()), np.uint64).reshape(-1, 4)
        held.append((batch.column("conv_id").to_numpy(), np.diff(offsets).astype(np.int64), digests,
                     turns.field("words").to_numpy(zero_copy_only=False).astype(np.int64)))
        load += batch.num_rows + len(digests)
        if load >= limit:
            yield shard_rows(shard, *map(np.concatenate, zip(*held, strict=True)))
            held, load, shard = [], 0, shard + 1
    if load:
        yield shard_rows(shard, *map(np.concatenate, zip(*held, strict=True)))


def hashed_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by key and first identifier -> one digest of each key's joined identifiers."""
    key, state = None, hashlib.sha256()

    def out():
        return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], ["key", "ends"])

    for batch in batches:
        for k, text in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist(), strict=True):
            if k != key:
                if key is not None:
                    yield out()
                key, state = k, hashlib.sha256()
            else:
                state.update(b",")
            state.update(text.encode())
    if key is not None:
        yield out()


def paths(conversations: DataFrame) -> DataFrame:
    """conv_id, steps: array<struct<digest, words>> in the order of turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    steps = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", digest.alias("digest"), n_words(text).alias("words")).alias("step"))
    return steps.groupBy("conv_id").agg(F.sort_array(F.collect_list("step")).alias("steps")).select(
        "conv_id", F.transform("steps", lambda s: F.struct(s["digest"].alias("digest"), s["words"].alias("words"))).alias("steps"))


def starts_shared(own: DataFrame) -> DataFrame:
    """Paths whose first turns are those of their group's first conversation (the contract's rebuilding)."""
    borrowed = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % STARTS).cast("int")
    own = materialize(own, "conversations")
    heads = own.filter(F.col("conv_id") % GROUP == 0).select(
        F.col("conv_id").alias("head_of"), F.slice("steps", 1, MOST_BORROWED).alias("head"))
    return (own.withColumn("head_of", F.col("conv_id") - F.col("conv_id") % GROUP).join(heads, "head_of", "left")
            .select("conv_id", F.concat(F.coalesce(F.slice("head", F.lit(1), borrowed), F.slice("steps", 1, 0)),
                                        F.slice("steps", borrowed + 1, F.size("steps"))).alias("steps")))


def over_subtrees(nodes: DataFrame, sums: list[str]) -> DataFrame:
    """nodes (key, parent_key, sums...) with each sum taken over the node's subtree."""
    reach = nodes.select("key", F.col("parent_key").alias("far"), *sums)
    while not reach.filter(F.col("far").isNotNull()).isEmpty():
        # Those ``far`` below bring what they have gathered; everyone looks twice as far up from then on.
        brought = reach.filter(F.col("far").isNotNull()).groupBy(F.col("far").alias("key")).agg(*[F.sum(s).alias(f"more_{s}") for s in sums])
        further = reach.select(F.col("key").alias("far"), F.col("far").alias("further"))
        reach = materialize(reach.join(brought, "key", "left").join(further, "far", "left").select(
            "key", F.col("further").alias("far"), *[(F.col(s) + F.coalesce(f"more_{s}", F.lit(0))).alias(s) for s in sums]), "trie-reach")
    return reach.drop("far")


def prefix_trie(steps: DataFrame) -> DataFrame:
    """The trie of (conv_id, steps), a row per node: conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    order = F.transform("steps", lambda s: s["digest"])
    sorted_rows = (steps.select("conv_id", "steps", order.alias("path")).repartitionByRange("path", "conv_id")
                   .sortWithinPartitions("path", "conv_id").select("conv_id", "steps"))
    rows = materialize(sorted_rows.mapInArrow(shards, SHARD_ROWS), "trie-shards")

    parts = rows.filter(F.col("kind") == SPINE)
    sums = ("n_convs", "n_children", "n_leaves", "saved")
    spine = materialize(parts.groupBy("key").agg(
        F.min("parent_key").alias("parent_key"), F.min("depth").alias("depth"), F.min("words").alias("words"),
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in sums]), "trie-spines")
    kids = spine.filter(F.col("parent_key").isNotNull()).groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("kids"))
    spine = materialize(spine.join(kids, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("kids", F.lit(0))).select(
        "key", "parent_key", "depth", "conv_id", "n_convs", "n_children",
        (F.col("n_leaves") + (F.col("n_children") == 0).cast("long")).alias("n_leaves"),
        (F.col("saved") + (F.col("n_convs") - 1) * F.col("words")).alias("saved")), "trie-spines")
    totals = over_subtrees(spine, ["n_leaves", "saved"])
    ends = (rows.filter(F.col("kind") == PIECE).select("key", "conv_id", "ends").repartition("key")
            .sortWithinPartitions("key", "conv_id").select("key", "ends").mapInArrow(hashed_pieces, "key binary, ends string"))
    above = spine.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    shown = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
             F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256")]
    spines = (spine.drop("n_leaves", "saved").join(totals, "key").join(ends, "key", "left").join(above, "parent_key", "left").select(*shown))

    whole = rows.filter(F.col("kind") == COMPLETE)
    # Each shard has its own copy of its spine, so a node with very many children is no hot key.
    named = parts.select("shard", "key").join(spine.select("key", F.col("conv_id").alias("named")), "key").withColumnRenamed("key", "parent_key")
    hung = (whole.filter(F.col("parent_key").isNotNull()).drop("parent_conv_id").join(named, ["shard", "parent_key"])
            .withColumnRenamed("named", "parent_conv_id").select(*shown))
    return whole.filter(F.col("parent_key").isNull()).select(*shown).unionByName(hung).unionByName(spines)


def op11(conversations: DataFrame) -> DataFrame:
    return prefix_trie(starts_shared(paths(conversations)))


_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''),
  lambda c: ascii(c)::BIGINT)), lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
  lambda v, k: xor(v >> 1, 3988292384::BIGINT * (v & 1)))), 4294967295::BIGINT)"""
SQL = rf"""WITH turns AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(octet_length(encode(role)) || ':' || role || text)) - 1 AS k
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
convs AS (SELECT conv_id, conv_id - conv_id % 20 AS head, ({_CRC}) % 4 AS h FROM (SELECT DISTINCT conv_id FROM turns)),
steps AS (SELECT c.conv_id, t.k, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.head AND t.k < c.h
  UNION ALL SELECT c.conv_id, t.k, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.k >= c.h),
paths AS (SELECT c.conv_id, coalesce(list({{'r': s.role, 't': s.text}} ORDER BY s.k) FILTER (s.k IS NOT NULL), []) AS path
  FROM convs c LEFT JOIN steps s ON s.conv_id = c.conv_id GROUP BY 1),
prefixes AS (SELECT conv_id, path[1:d] AS p, d FROM (SELECT conv_id, path, unnest(range(len(path) + 1)) AS d FROM paths)),
nodes AS (SELECT p, any_value(d) AS d, min(conv_id) AS conv_id, count(*) AS n FROM prefixes GROUP BY p),
kids AS (SELECT p[1:d - 1] AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
ends AS (SELECT path AS p, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS h FROM paths GROUP BY 1),
own AS (SELECT n.*, coalesce(k.n, 0) AS n_children,
    CASE WHEN d = 0 THEN 0 ELSE (n.n - 1) * len(regexp_extract_all(p[d].t, '[^\x20\x09-\x0D]+')) END AS saved
  FROM nodes n LEFT JOIN kids k USING (p)),
sums AS (SELECT p[1:a] AS p, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved
  FROM (SELECT *, unnest(range(d + 1)) AS a FROM own) GROUP BY 1)
SELECT o.conv_id, o.d AS depth, u.conv_id AS parent_conv_id, o.n AS n_convs, o.n_children, s.n_leaves,
  s.saved AS saved_tokens, coalesce(e.h, sha256('')) AS ends_sha256
FROM own o JOIN sums s USING (p) LEFT JOIN ends e USING (p) LEFT JOIN nodes u ON o.d > 0 AND u.p = o.p[1:o.d - 1]
"""
