import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from airindex.llm.chat_format import escape, format_chats, op7, parse, unescape
from airindex.llm.mixing import mix_documents, mix_to_weights, op2, sainte_lague
from tests.llm.helpers import corpus, frame, words


def targets(sizes):
    """The contract's targets: reshare what stands above twice a source's size until none does."""
    names = sorted([s for s in sizes if s is not None]) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), {}
    while True:
        rest = {s: w for s, w in weight.items() if s not in full}
        left = total - sum(full.values())
        share = {s: left * w / sum(rest.values()) for s, w in rest.items()}
        over = [s for s in rest if share[s] > 2 * sizes[s]]
        if not over:
            return full | share
        full.update({s: 2.0 * sizes[s] for s in over})


def test_targets_and_takes(spark):
    rows = corpus(docs=200)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(words(t))
    want, got = targets(sizes), op2(frame(spark, rows)).collect()
    source = {d: s for d, _, s in rows}
    taken = defaultdict(int)
    assert len(got) == len(rows)
    for r in got:
        s = source[r["doc_id"]]
        assert r["target"] == pytest.approx(want[s]) and r["source_size"] == sizes[s]
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    for s in sizes:
        assert taken[s] == pytest.approx(want[s], rel=0.02)
    assert sorted(map(tuple, got)) == sorted(map(tuple, op2(frame(spark, rows)).collect()))


def test_many_groups_of_shards_share_all_blocks(spark):
    """With groups of few shards the mix is as near its targets, and reruns agree."""
    rows = corpus(docs=400)
    few = {"docs_per_shard": 8, "shards_per_group": 5}
    got = mix_to_weights(frame(spark, rows), **few).collect()
    taken, target = defaultdict(int), {}
    for r in got:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    assert len(got) == len(rows) and all(taken[s] == pytest.approx(target[s], rel=0.03) for s in target)
    assert sorted(map(str, got)) == sorted(map(str, mix_to_weights(frame(spark, rows), **few).collect()))


def test_sainte_lague_is_seat_by_seat(spark):
    votes = {f"p{i}": v for i, v in enumerate((53, 24, 23, 7, 1, 0, 1000, 999, 3.5))}
    for house in (0, 1, 7, 20, 21, 500):
        seats = dict.fromkeys(votes, 0)
        for _ in range(house):
            seats[max(votes, key=lambda p: (votes[p] / (2 * seats[p] + 1), -int(p[1:])))] += 1
        cells = spark.createDataFrame([(p, float(v)) for p, v in votes.items()], "p string, v double")
        got = {r["p"]: r["s"] for r in sainte_lague(cells, "v", F.lit(house), [], ["p"], "s").collect()}
        assert got == seats


def test_mix_edges(spark):
    assert op2(frame(spark, [])).count() == 0
    out = op2(frame(spark, [(1, None, "a"), (2, "", None)])).collect()
    assert sorted(tuple(r) for r in out) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    rows = [(None, "a b c d", None), (7, "a b c", "s"), (7, "a b c", "s"), (8, "x " * 50, "s")]
    docs = frame(spark, rows).withColumn("size", F.lit("clash")).withColumn("skey", F.lit("kept"))
    mixed = mix_documents(docs).collect()
    assert {r["skey"] for r in mixed} == {"kept"} and all(r["taken"] <= 2 * r["size"] for r in mixed)
    assert mix_to_weights(docs).count() == 4


CHATS = [
    (1, 0, "system", "Be: #brief# \\h <b>"), (1, 1, "user", "### User: hi </turn>\n"), (1, 2, "assistant", "\\l\\b:\\c ### "),
    (2, 1, "assistant", None), (2, 0, "user", ""), (3, 0, "assistant", "first"), (3, 0, "assistant", "first"),
    (4, None, None, "no role"), (4, 5, "we: #ird\\", "x"), (None, 0, "user", "你好 \U0001f600" * 5000), (5, 0, "system", "alone")]


def test_chat_round_trip(spark):
    rows = spark.createDataFrame(CHATS, "conv_id long, turn long, role string, text string").withColumn("segments", F.lit(1))
    want = defaultdict(list)
    for c, t, r, x in CHATS:
        want[c].append((t is not None, t or 0, r or "", x or ""))
    spoken = "\\### Assistant: </turn> ok"
    want[-7] = [(True, 0, "user", spoken), (True, 1, "assistant", spoken)]
    got = {r["conv_id"]: r for r in op7(rows).collect()}
    assert got.keys() == want.keys()
    for c, turns in want.items():
        turns = [(r, x) for _, _, r, x in sorted(turns)]
        learned = "".join(x for r, x in turns if r == "assistant")
        whole = "".join(f"{r}\n{x}\n" for r, x in turns)
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert got[c]["loss_chars"] == len(learned)
        assert got[c]["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()
    assert [c for c in sorted(k for k in got if k is not None) if got[c]["valid"]] == [-7, 1, 2]


def test_escapes_leave_no_control_character(spark):
    nasty = ["\\", "\\\\h", "\\h", "#", "\\#", "</turn>\n", "a\\b\\l<", ":::", "\\c:"]
    rows = spark.createDataFrame([(x,) for x in nasty], "x string").select("x", escape(F.col("x")).alias("e"))
    for r in rows.select("x", "e", unescape(F.col("e")).alias("back")).collect():
        assert not set("#<:") & set(r["e"]) and r["back"] == r["x"]


def test_chat_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert [r["conv_id"] for r in op7(empty).collect()] == [-7]
    assert format_chats(empty).select(parse(F.col("formatted"))).collect() == []
