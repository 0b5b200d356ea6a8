import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from airindex.llm import decontaminate as dc
from airindex.llm.quality_classifier import PuNetwork, estimated_prior, op9
from airindex.llm.token_counts import RankMerger, op5
from tests.llm.helpers import by_id, corpus, frame, prose, sha, words

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"


def test_token_counts_match_the_library(spark):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(TOKENIZER)
    rng = random.Random(1)
    alphabet = ["ab", " ", "  ", "\n", "'s", "t", "é", "　", "\U0001f600", "\t", "12", "<|endoftext|>", "\x1f", "​", "½", "你", "'LL", "..", "\x85"]
    rows = corpus() + [(9000 + i, "".join(rng.choice(alphabet) for _ in range(rng.randrange(200))), "s") for i in range(150)]
    rows += [(9500, "a" * 30_000, "s"), (9501, "<|endoftext|>" * 3, "s"), (9502, " " * 5000 + "x", None)]
    got = by_id(op5(frame(spark, rows)))
    want = [len(e.ids) for e in library.encode_batch([t or "" for _, t, _ in rows], add_special_tokens=False)]
    for (d, t, _), n in zip(rows, want, strict=True):
        assert tuple(got[d])[1:] == (len((t or "").encode()), n, n > 512), d


def test_equal_pairs_merge_from_the_left():
    merger = RankMerger(TOKENIZER)
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(TOKENIZER)
    for text in ("aaaaa", "=" * 77, "the" * 9, "lalalalala"):
        assert merger.text_counts([text]) == [len(library.encode(text, add_special_tokens=False).ids)]


def test_long_pre_tokens_match_the_library():
    """A pre-token of a megabyte takes seconds, and counts as the library counts it."""
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(TOKENIZER)
    merger = RankMerger(TOKENIZER)
    rng = random.Random(7)
    word = prose("long", 90_000, 2000)
    texts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5000)), "a" * 4001, "abab" * 900 + "a", "=" * 3000,
             re.sub(r"[^a-z]", "", word.replace("w", "the ing")) * 1, "é" * 1500, " " * 2000, "0123456789" * 300]
    texts.append("".join(rng.choice(["the", "and", "q", "zz", "ing", "o"]) for _ in range(400_000)))
    assert len(texts[-1]) > 800_000
    began = time.time()
    assert merger.text_counts(texts) == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert time.time() - began < 60
    for _ in range(40):
        text = "".join(rng.choice(["a", "aa", "b", "ab", "in", "th", "e"]) for _ in range(rng.randrange(1, 60)))
        assert merger.long_count(text.encode()) == int(merger.counts([text.encode()])[0])


def test_token_counts_edges(spark):
    docs = frame(spark, [(None, "a", "s"), (1, None, "s"), (1, None, "s")]).withColumn("n_tokens", F.lit(0))
    assert sorted((r["n_bytes"], r["n_tokens"]) for r in op5(docs).collect()) == [(0, 0), (0, 0), (1, 1)]
    assert op5(frame(spark, [])).count() == 0


def bench_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def contamination(rows, items):
    phrases = {}
    for i, t in items:
        ws = bench_words(t)
        for p in range(max(1, len(ws) - 9) if ws else 0):
            phrases.setdefault(tuple(ws[p:p + 10]), set()).update([] if i is None else [str(i)])
    out = {}
    for d, t, _ in rows:
        ws, hit, found = bench_words(t), set(), set()
        for p in range(len(ws)):
            for n in range(1, 11):
                k = tuple(ws[p:p + n])
                if len(k) == n and k in phrases:
                    hit.update(range(p, p + n))
                    found |= phrases[k]
        out[d] = (len(ws), len(hit), len(found), sha(",".join(sorted(found))), bool(hit))
    return out


def bench_rows():
    items = [(i, prose(f"item{i}", 6 + 9 * i, 60)) for i in range(6)] + [(20, "Three Word item"), (21, "three; word, ITEM!"), (22, None), (23, " ?!"),
             (None, "w1 w2 w3 w4"), (10, prose("item3", 33, 60)), (24, "na na na na na na na na na na na na"), (25, "ÉÑ über 你好")]
    rng = random.Random(2)
    rows = corpus(docs=30)
    for d in range(30):
        ws = words(items[rng.randrange(6)][1])
        i = rng.randrange(len(ws))
        cut = ws[i: i + rng.randrange(1, 40)]
        rows.append((7000 + d, prose(f"x{d}", rng.randrange(30), 60) + " " + ", ".join(cut).upper() + "\n" + prose(f"y{d}", rng.randrange(30), 60), "s"))
    rows += [(7100, "a three WORD itEm three word item", "s"), (7101, "na " * 40, "s"), (7102, "x ÉÑ ÜBER über 你好", "s"), (7103, "x ÉÑ über 你好", "s"),
             (7104, " ".join(t for _, t in items[:6]), None)]
    return rows, items


@pytest.mark.parametrize("block_bytes", [1 << 24, 200])
def test_contamination_against_brute_force(spark, block_bytes):
    rows, items = bench_rows()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = dc.find_contamination(frame(spark, rows).select("doc_id", "text"), benchmark, block_bytes=block_bytes)
    want = contamination(rows, items)
    assert sum(w[4] for w in want.values()) > 10
    for r in found.collect():
        n_hit = sum(s["words"] for s in r["spans"])
        assert (r["n_words"], n_hit, len(r["items"]), sha(",".join(r["items"])), bool(r["spans"])) == want[r["doc_id"]], r["doc_id"]
        data = (r["text"] or "").encode()
        assert sum(len(bench_words(data[s["start"]: s["end"]].decode())) for s in r["spans"]) == n_hit
    if block_bytes > 200:
        got = by_id(dc.op4(frame(spark, rows), benchmark))
        assert {d: tuple(got[d])[1:] for d in got} == want


def test_fm_index_ranks_and_locates():
    rng = np.random.default_rng(3)
    text = rng.integers(0, 6, 3000)
    text[-1] = 0
    index = dc.FmIndex(text, 6)
    for c in range(7):
        for upto in (0, 1, 17, 1500, 3000):
            assert index.rank(np.array([c]), np.array([upto]))[0] == (index.bwt[:upto] == c).sum()
    rows = np.array([[0, 2, 3], [1, 1, 1], [4, 5, 1], [0, 0, 2]])
    lengths = np.array([2, 3, 3, 1])
    phrase, low, high = index.search(rows, lengths)
    which, position = index.locate(low, high)
    for p in range(len(rows)):
        want = [i for i in range(3000) if text[i: i + lengths[p]].tolist() == rows[p, 3 - lengths[p]:].tolist()]
        assert sorted(position[phrase[which] == p].tolist()) == want


def test_decontaminate_cuts_spans_and_keeps_columns(spark):
    items = spark.createDataFrame([(1, "one two three four")], "item_id long, text string")
    docs = frame(spark, [(1, "Ä: One, two three FOUR! end", "s"), (2, "clean", "s"), (3, None, None), (3, None, None)])
    docs = docs.withColumn("spans", F.lit("clash")).withColumn("clean", F.lit(2)).withColumn("n_words", F.lit(3))
    out = dc.decontaminate(docs, items)
    assert out.columns == docs.columns
    rows = sorted((r["doc_id"], r["text"], r["n_chars"]) for r in out.collect() if r["text"] is not None)
    assert rows == [(1, "Ä: ! end", 8), (2, "clean", 5)] and out.count() == 4
    empty = spark.createDataFrame([], "item_id long, text string")
    assert dc.decontaminate(docs, empty).count() == 4
    assert dc.op4(frame(spark, []), items).count() == 0


def test_classifier_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = op9(docs, labels).toPandas().set_index("doc_id").join(labels.toPandas().set_index("doc_id"), how="left")
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    assert ((got.score >= 0.3).astype(int) == got.predicted).all()
    test = got[got.held_out & got.quality.notna()]
    good, bad = test.score[test.quality == 1].to_numpy(), test.score[test.quality == 0].to_numpy()
    assert (good[:, None] > bad[None, :]).mean() > 0.97
    assert (test.predicted == test.quality).mean() > 0.93


def test_classifier_where_every_row_has_a_label(spark):
    rows = [(d, f"Plain text of document {d}. " + prose(d, 80) if d % 2 else f"## {d} || $$ %% 77 <b>\n" * 20, "s") for d in range(300)]
    labels = spark.createDataFrame([(d, d % 2, 0) for d, _, _ in rows], "doc_id long, quality int, toxic int")
    got = by_id(op9(frame(spark, rows), labels))
    assert all(got[d]["predicted"] == d % 2 for d in got if got[d]["held_out"])
    assert {r["predicted"] for r in got.values()} == {0, 1}


def test_labels_of_held_out_rows_are_never_used(spark):
    rows = corpus()
    labels = spark.createDataFrame([(d, d % 2, 0) for d, _, _ in rows], "doc_id long, quality int, toxic int")
    import zlib
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = by_id(op9(frame(spark, rows), labels)), by_id(op9(frame(spark, rows), flipped))
    assert {d: a[d]["score"] for d in a} == {d: b[d]["score"] for d in b}
    assert all(a[d]["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d in a)


def test_classifier_edges(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = frame(spark, [(None, "text", "s"), (1, None, "s"), (1, "", "s")]).withColumn("x", F.lit(1)).withColumn("score", F.lit(1))
    assert {r["score"] for r in op9(docs, none).collect()} == {0.5}
    assert op9(frame(spark, []), none).count() == 0
    odd = spark.createDataFrame([(1, None, 0), (1, 7, 0), (2, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    assert op9(docs, odd).count() == 3


def test_classifier_needs_positives_alone(spark):
    """Without any negative label the scores are the same; the prior comes from the mixture."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    both = by_id(op9(docs, labels))
    alone = by_id(op9(docs, labels.filter("quality = 1")))
    assert {d: r["score"] for d, r in both.items()} == {d: r["score"] for d, r in alone.items()}
    quality = {r["doc_id"]: r["quality"] for r in labels.collect()}
    test = [(alone[d]["score"], q) for d, q in quality.items() if alone[d]["held_out"]]
    good, bad = [s for s, q in test if q == 1], [s for s, q in test if q == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.97 and np.mean([b >= 0.3 for b in bad]) < 0.3


@pytest.mark.parametrize("share", [0.15, 0.5, 0.85])
def test_prior_is_estimated_from_positives_and_a_mixture(share):
    rng = np.random.default_rng(4)
    positive = rng.normal(2.5, 1, (3000, 3))
    mixture = np.where(rng.random((6000, 1)) < share, rng.normal(2.5, 1, (6000, 3)), rng.normal(-1, 1, (6000, 3)))
    assert estimated_prior(positive, mixture) == pytest.approx(share, abs=0.06)
    assert estimated_prior(positive[:2], mixture) == 0.5


def test_risk_separates_positives_from_a_mixture():
    rng = np.random.default_rng(4)
    positive = rng.normal(1.5, 1, (800, 3))
    mixture = np.vstack([rng.normal(1.5, 1, (1200, 3)), rng.normal(-1.5, 1, (800, 3))])
    network = PuNetwork(3)
    network.fit(positive, mixture, 0.6, epochs=40)
    assert (network.scores(mixture[:1200]) > 0.5).mean() > 0.95 and (network.scores(mixture[1200:]) < 0.5).mean() > 0.95


def morse(n, a="a", b="b"):
    x = [a]
    while len(x) < n:
        x += [b if c == a else a for c in x]
    return "".join(x[:n])


def test_words_built_to_collide_are_no_matches(spark):
    """Thue-Morse words have one hash under any polynomial modulo a power of two; their bytes differ."""
    x, y = morse(1024), morse(1024, "b", "a")
    rows = [(1, f"see {x} there", "s"), (2, f"see {y} there", "s"), (3, f"{x} {y}", "s")]
    items = [(1, x), (2, f"{y} again")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = by_id(dc.op4(frame(spark, rows), bench))
    want = contamination(rows, items)
    assert {d: got[d]["n_hit"] for d in got} == {d: w[1] for d, w in want.items()}
    assert [got[d]["contaminated"] for d in (1, 2, 3)] == [True, False, True]
    phrases = dc.Phrases([1, 2], [x, y], 10)
    assert len(phrases.vocabulary) == 2
