import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from airindex.llm import conversation_trie
from airindex.llm.conversation_trie import Parens, op11, paths, prefix_trie, range_minima
from tests.llm.helpers import words

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            digest = hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).hexdigest()
            own[c].append((t is not None, t or 0, digest, r, x))
    own = {c: [(r, x) for _, _, _, r, x in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = tuple(own.get(c - int(np.fmod(c, 20)), [])[:h] + turns[h:])
    return out


def brute(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c, path in convs.items():
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    kids = defaultdict(set)
    for p in members:
        if p:
            kids[p[:-1]].add(p)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * len(words(p[-1][1])) if p else 0
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items()), key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def chats(seed=5, n=160):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        c = c * 3 if c % 2 else c
        for t in range(rng.randrange(1, 7)):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"say {rng.randrange(2)}" if rng.random() < 0.8 else f"only {c}"))
    rows = list(dict.fromkeys(rows))
    rows += [(1000, 0, "user", "alone"), (1013, 0, None, None), (1013, None, "", "first"), (1013, 2, "user", "twice"), (1013, 2, "user", "twice"),
             (1014, 2, "b", "tie"), (1014, 2, "a", "tie"), (None, 0, "user", "nobody's"), (-7, 0, "user", "say 0"), (-20, 0, "user", "say 1")]
    return rows


@pytest.mark.parametrize("limit", [1, 7, 60, 200_000])
def test_trie_over_shards_of_any_size(spark, monkeypatch, limit):
    monkeypatch.setattr(conversation_trie, "SHARD_TURNS", limit)
    rows = chats()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("steps", F.lit("clash")).withColumn("key", F.lit(1))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert got(op11(df)) == brute(rebuilt(rows))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_turnless_conversation_is_a_member_of_the_root(spark):
    short = next(c for c in range(21, 400) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(short, 0, "user", "gone"), (800, 0, "user", "x y z"), (801, 0, "user", "x y z")]
    out = got(op11(spark.createDataFrame(rows, SCHEMA)))
    assert out == brute(rebuilt(rows)) and rebuilt(rows)[short] == ()
    assert op11(spark.createDataFrame([], SCHEMA)).count() == 0


def test_hot_and_deep(spark, monkeypatch):
    """One path of a third of all conversations, over many shards, and a very deep one that splits late."""
    monkeypatch.setattr(conversation_trie, "SHARD_TURNS", 40)
    rows = [(c, t, "user", f"hot {t}") for c in range(0, 2000, 20) for t in range(3)]
    rows += [(c, 0, "user", f"own {c}") for c in range(0, 4000, 20)]
    deep = [(c, t, "user", f"deep {t} a b" if t < 700 or c == 9000 else f"{c}") for c in (9000, 9020) for t in range(720)]
    rows += deep
    assert got(op11(spark.createDataFrame(rows, SCHEMA))) == brute(rebuilt(rows))


def test_plain_conversations(spark):
    rows = [(c, t, "user", x) for c, text in enumerate(["a b", "a c", "a", "b"]) for t, x in enumerate(text.split())]
    out = {(r["conv_id"], r["depth"]): r for r in prefix_trie(paths(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert out[0, 0]["n_convs"] == 4 and out[0, 0]["n_leaves"] == 3 and out[0, 0]["saved_tokens"] == 2
    assert out[0, 1]["n_children"] == 2 and out[0, 1]["parent_conv_id"] == 0 and (2, 1) not in out


def test_long_text(spark):
    rows = [(0, 0, "user", "word " * 300_000), (20, 0, "user", "word " * 300_000)]
    assert got(op11(spark.createDataFrame(rows, SCHEMA))) == brute(rebuilt(rows))


@pytest.mark.parametrize("n", [1, 2, 300, 5000])
def test_findclose_and_minima(n):
    rng = random.Random(n)
    bits, depth, opened = [True], 1, 1
    while opened < n or depth > 1:
        if opened < n and (depth == 1 or rng.random() < 0.52):
            bits.append(True)
            depth, opened = depth + 1, opened + 1
        else:
            bits.append(False)
            depth -= 1
    bits = np.array([*bits, False])
    stack, close = [], {}
    for i, b in enumerate(bits):
        if b:
            stack.append(i)
        else:
            close[stack.pop()] = i
    opens = np.flatnonzero(bits)
    assert Parens(bits).findclose(opens).tolist() == [close[i] for i in opens.tolist()]
    chain = np.array([True] * n + [False] * n)
    assert Parens(chain).findclose(np.arange(n)).tolist() == list(range(2 * n - 1, n - 1, -1))
    values = np.array([rng.randrange(-999, 999) for _ in range(n)])
    first = np.array([rng.randrange(n) for _ in range(200)])
    end = np.array([rng.randrange(f + 1, n + 1) for f in first.tolist()])
    assert range_minima(values, first, end).tolist() == [values[a:b].min() for a, b in zip(first, end, strict=True)]
