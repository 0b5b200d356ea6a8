import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from airindex.llm import anchors
from airindex.llm.near_dup import bag_minhash, classes_of, keep_one_of_each, op10
from airindex.llm.substring_dedup import op1
from airindex.llm.suffix_dedup import collection_index, op8
from tests.llm.helpers import by_id, corpus, frame, prose, sha, words


def word_dedup(rows):
    first = {}
    for d, t, _ in rows:
        ws = words(t)
        for i in range(len(ws) - 49):
            k = tuple(ws[i:i + 50])
            first[k] = min(first.get(k, d), d)
    out = {}
    for d, t, _ in rows:
        ws = words(t)
        gone = {q for i in range(len(ws) - 49) if first[tuple(ws[i:i + 50])] < d for q in range(i, i + 50)}
        out[d] = (len(ws), len(gone), sha(" ".join(w for i, w in enumerate(ws) if i not in gone)))
    return out


def byte_dedup(rows):
    seen, out = set(), {}
    for d, t, _ in sorted(rows, key=lambda r: r[0]):
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, int)
        for i in range(len(b) - 99):
            if b[i:i + 100] in seen:
                gone[i:i + 100] = 1
            seen.add(b[i:i + 100])
        out[d] = (len(b), int(gone.sum()), int((np.diff(gone, prepend=0) == 1).sum()),
                  sha(bytes(x for x, g in zip(b, gone, strict=False) if not g)))
    return out


def tangled(seed):
    """Texts made of overlapping cuts of few passages, so that matches chain over many sources."""
    rng = random.Random(seed)
    base = [words(prose(f"b{i}", 300, 40)) for i in range(3)]
    rows = []
    for d in range(40):
        text = []
        for _ in range(rng.randrange(1, 5)):
            b, i = rng.choice(base), rng.randrange(250)
            text += b[i: i + rng.randrange(20, 120)] + words(prose(rng.random(), rng.randrange(0, 6), 40))
        rows.append((d, " ".join(text), "s"))
    return rows + [(100, "z " * 300, "s"), (101, "z " * 220 + "end", "s"), (102, "za" * 400, "s")]


@pytest.mark.parametrize("make", [corpus, lambda: tangled(1), lambda: tangled(2)])
def test_word_windows_against_brute_force(spark, make):
    rows = make()
    got = by_id(op1(frame(spark, rows)))
    want = word_dedup(rows)
    assert {d: tuple(got[d])[1:] for d in got} == want
    assert sum(w[1] for w in want.values()) > 0


@pytest.mark.parametrize("make", [corpus, lambda: tangled(3)])
def test_byte_windows_against_brute_force(spark, make):
    rows = make()
    got = by_id(op8(frame(spark, rows)))
    assert {d: tuple(got[d])[1:] for d in got} == byte_dedup(rows)


@pytest.mark.parametrize("inside", [False, True])
@pytest.mark.parametrize("length", [101, 150, 163, 227])
def test_lone_periodic_texts_lose_their_own_repeats(spark, length, inside):
    rows = []
    for d, unit in enumerate(["a", "-", "ab", "xyz", "0123456", "\n", "é"]):
        text = (unit * length).encode()[:length + length % 2].decode()
        rows.append((d, f"{prose(d, 30)} {text} {prose(-d - 1, 30)}" if inside else text, "s"))
    got = by_id(op8(frame(spark, rows)))
    assert {d: tuple(got[d])[1:] for d in got} == byte_dedup(rows)
    assert got[0]["n_removed"] >= length - 1


def test_crowded_anchors_give_the_same_rows(spark, monkeypatch):
    monkeypatch.setattr(anchors, "MAX_RIVALS", 2)
    rows = tangled(4)
    got = by_id(op1(frame(spark, rows)))
    assert {d: tuple(got[d])[1:] for d in got} == word_dedup(rows)
    got = by_id(op8(frame(spark, rows)))
    assert {d: tuple(got[d])[1:] for d in got} == byte_dedup(rows)


def test_dedup_nulls_repeats_empty(spark):
    assert op1(frame(spark, [])).count() == 0 and op8(frame(spark, [])).count() == 0 and op10(frame(spark, [])).count() == 0
    text = prose(1, 80)
    rows = [(None, text, "s"), (5, text, "s"), (5, text, "s"), (5, "short", "s"), (6, None, None)]
    docs = frame(spark, rows).withColumn("spans", F.lit("clash")).withColumn("anchor", F.lit(1))
    removed = Counter((r["doc_id"], r["n_words"], r["n_removed"]) for r in op1(docs).collect())
    # The null id is the smallest, so the others are copies of it; the short text shares an id and nothing else.
    assert removed == Counter({(None, 80, 0): 1, (5, 80, 80): 2, (5, 1, 0): 1, (6, 0, 0): 1})
    n = len(text.encode())
    assert Counter((r["doc_id"], r["n_removed"], r["n_spans"]) for r in op8(docs).collect()) == Counter(
        {(None, 0, 0): 1, (5, n, 1): 2, (5, 0, 0): 1, (6, 0, 0): 1})


def test_rows_that_share_an_id_keep_their_own_words(spark):
    """A span holds for its own text: clean rows with the same (or no) doc_id lose nothing."""
    a, z, own = prose(1, 60), " ".join(f"z{i}" for i in range(60)), prose(2, 130)
    rows = [(1, a, "s"), (2, a, "s"), (2, z, "s"), (None, z + " end", "s"), (None, own, "s"), (3, own, "s"), (3, f"{own} {own}", "s"), (3, f"{own} {own}", "s")]
    one = Counter((r["doc_id"], r["n_words"], r["n_removed"]) for r in op1(frame(spark, rows)).collect())
    assert one == Counter({(1, 60, 0): 1, (2, 60, 60): 2, (None, 61, 0): 1, (None, 130, 0): 1, (3, 130, 130): 1, (3, 260, 260): 2})
    alone = [(1, a, "s"), (2, a, "s"), (2, z, "s"), (4, f"{own} {own}", "s"), (4, f"{own} {own}", "s"), (4, own, "s")]
    two = Counter((r["doc_id"], r["n_bytes"], r["n_removed"]) for r in op8(frame(spark, alone)).collect())
    n = len(own)
    assert two == Counter({(1, len(a), 0): 1, (2, len(a), len(a)): 1, (2, len(z), 0): 1, (4, 2 * n + 1, n): 2, (4, n, 0): 1})


def morse(n, a="a", b="b"):
    x = [a]
    while len(x) < n:
        x += [b if c == a else a for c in x]
    return x


def test_texts_built_to_collide_stay_apart(spark):
    """Thue-Morse words and their complements: equal to any polynomial hash modulo a power of two."""
    x, y = "".join(morse(1024)), "".join(morse(1024, "b", "a"))
    rows = [(1, " ".join([x] + [f"w{i}" for i in range(49)]), "s"), (2, " ".join([y] + [f"w{i}" for i in range(49)]), "s")]
    rows += [(3, f"{x} {x}", "s"), (4, f"{y} {y}", "s")]
    got = by_id(op1(frame(spark, rows)))
    assert {d: tuple(got[d])[1:] for d in got} == word_dedup(rows)
    got = by_id(op8(frame(spark, rows)))
    assert {d: tuple(got[d])[1:] for d in got} == byte_dedup(rows)
    words_x, words_y = " ".join(morse(2048, "aa", "bb")), " ".join(morse(2048, "bb", "aa"))
    rows = [(1, words_x, "s"), (2, words_y, "s"), (3, "q " + words_x, "s")]
    got = by_id(op1(frame(spark, rows)))
    assert {d: tuple(got[d])[1:] for d in got} == word_dedup(rows)


def test_anchors_do_not_depend_on_the_batch():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 1 << 62, 5000).astype(np.uint64)
    values[rng.integers(0, 5000, 800)] = np.uint64(7)  # ties
    for width in (1, 2, 43, 69):
        want = [i + int(np.argmin(values[i:i + width] >> np.uint64(31))) for i in range(len(values) - width + 1)]
        got = anchors.sliding_least(values, width)
        assert got.tolist() == want
        some = anchors.sliding_least(values[1000:1000 + 3 * width], width)
        assert (some + 1000 == got[1000:1000 + len(some)]).all()


def test_collection_index_orders_all_suffixes():
    rng = random.Random(5)
    rows = [bytes(rng.choice(b"ab\x00") for _ in range(rng.randrange(0, 30))) for _ in range(20)] + [b"", b"abab" * 8, b"abab" * 8]
    data = np.frombuffer(b"".join(rows), np.uint8)
    size = np.array([len(r) for r in rows])
    first = np.cumsum(size) - size
    stretch, length, prefix = collection_index(data, first, size)
    got = [rows[s][len(rows[s]) - n:] for s, n in zip(stretch, length, strict=True)]
    assert got == sorted(got) and len(got) == sum(size) + len(rows)
    assert Counter(zip(stretch.tolist(), length.tolist(), strict=True)) == Counter((i, n) for i, r in enumerate(rows) for n in range(len(r) + 1))
    for a, b, p in zip(got, got[1:], prefix[1:], strict=False):
        assert p == next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))


def test_bag_minhash_estimates_weighted_jaccard():
    rng = np.random.default_rng(1)
    m, tries = 128, 60
    a, b = {1: 3, 2: 1, 3: 5, 4: 8, 5: 1}, {1: 2, 2: 1, 3: 9, 6: 2}
    want = sum(min(a.get(k, 0), b.get(k, 0)) for k in {*a, *b}) / sum(max(a.get(k, 0), b.get(k, 0)) for k in {*a, *b})
    hits = 0
    for _ in range(tries):
        salt = rng.integers(1 << 62, size=7).astype(np.uint64)
        of = np.array([0] * len(a) + [1] * len(b))
        keys = np.array([salt[k] for k in [*a, *b]])
        sig = bag_minhash(of, keys, np.array([*a.values(), *b.values()]), 2, m)
        assert np.isfinite(sig).all()
        hits += int((sig[0] == sig[1]).sum())
    assert hits / (m * tries) == pytest.approx(want, abs=0.02)


def test_signatures_do_not_depend_on_the_batch():
    """A text has the same signature alone and among others, to the last bit: buckets must meet over batches."""
    rng = np.random.default_rng(2)
    sizes = [1, 3, 40, 700, 5, 2000, 12]
    bags = [(rng.integers(1 << 62, size=k).astype(np.uint64), rng.integers(1, 9, size=k)) for k in sizes]
    of = np.repeat(np.arange(len(sizes)), sizes)
    whole = bag_minhash(of, np.concatenate([b[0] for b in bags]), np.concatenate([b[1] for b in bags]), len(sizes), 160)
    for i, (keys, weights) in enumerate(bags):
        alone = bag_minhash(np.zeros(len(keys), np.int64), keys, weights, 1, 160)
        assert (alone[0] == whole[i]).all()


def test_classes_of_long_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(60, 0, -1)] + [(200, k) for k in range(100, 150)] + [(300, 7), (7, 7), (400, 401), (401, 400)]
    got = {r["node"]: r["class"] for r in classes_of(spark.createDataFrame(chain, "a long, b long")).collect()}
    want = dict.fromkeys(range(1, 62), 1) | {300: 1} | dict.fromkeys([200, *range(100, 150)], 100) | {400: 400, 401: 400}
    assert got == want
    assert classes_of(spark.createDataFrame([], "a long, b long")).count() == 0


def shingle_bag(text):
    ws = words(text)
    return Counter([tuple(ws)]) if 0 < len(ws) < 5 else Counter(tuple(ws[i:i + 5]) for i in range(len(ws) - 4))


def classes(rows):
    bags, parent = [shingle_bag(t) for _, t, _ in rows], list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = sum((bags[i] & bags[j]).values())
            if both and 5 * both >= 4 * (sum(bags[i].values()) + sum(bags[j].values()) - both):
                a, b = top(i), top(j)
                parent[max(a, b)] = min(a, b)
    return {rows[i][0]: rows[top(i)][0] for i in range(len(rows))}


def near_copies():
    """Chains and stars of edits around the threshold."""
    rng = random.Random(9)
    rows = []
    for g in range(6):
        base = words(prose(f"n{g}", 150))
        for k in range(14):
            ws = list(base) if k % 2 else list(ws) if k else list(base)  # noqa: F821
            for _ in range(rng.randrange(0, 5)):
                ws[rng.randrange(len(ws))] = f"e{rng.random()}"
            rows.append((len(rows), " ".join(ws), "s"))
    return rows + [(1000 + i, "tiny text", "s") for i in range(3)] + [(2000, None, "s"), (2001, "", "s"), (2002, "x " * 500, "s"), (2003, "x " * 420, "s")]


@pytest.mark.parametrize("make", [corpus, near_copies])
def test_near_dup_classes_against_brute_force(spark, make):
    rows = make()
    got = by_id(op10(frame(spark, rows)))
    assert {d: got[d]["class_id"] for d in got} == classes(rows)
    assert all(r["is_first"] == (r["doc_id"] == r["class_id"]) for r in got.values())


def test_shingles_built_to_collide_are_different(spark):
    x, y = "".join(morse(1024)), "".join(morse(1024, "b", "a"))
    rows = [(1, f"{x} one two three four", "s"), (2, f"{y} one two three four", "s"), (3, f"{x} one two three  four", "s")]
    got = by_id(op10(frame(spark, rows)))
    assert {d: got[d]["class_id"] for d in got} == classes(rows) == {1: 1, 2: 2, 3: 1}


def test_one_of_each_stays(spark):
    text = prose(1, 40)
    rows = [(None, text, "s"), (3, text, "t"), (4, "own words here", "s"), (4, "own words here", "s"), (5, None, None), (6, "", "s")]
    docs = frame(spark, rows).withColumn("tid", F.lit("clash")).withColumn("class", F.lit(1))
    out = keep_one_of_each(docs)
    assert out.columns == docs.columns
    assert Counter(r["doc_id"] for r in out.collect()) == Counter({None: 1, 4: 1, 5: 1, 6: 1})
