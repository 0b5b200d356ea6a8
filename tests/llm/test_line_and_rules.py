from collections import Counter

from pyspark.sql import functions as F

from airindex.llm.line_dedup import drop_common_lines, keep_bitmaps, op3
from airindex.llm.quality_rules import keep_good, op6
from tests.llm.helpers import BLANK, by_id, corpus, frame, sha, words

BLANKS = " \t\n\x0b\f\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def test_lines_against_brute_force(spark):
    rows = [(d, t if d % 2 else f"{t or ''}\n ÄLL shared\tX ", s) for d, t, s in corpus()]
    holders = Counter(k for _, t, _ in rows for k in {key(x) for x in (t or "").split("\n")} if k)
    got = by_id(op3(frame(spark, rows)))
    assert len(got) == len(rows)
    for d, t, _ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if holders[key(x)] < 10]
        assert tuple(got[d])[1:] == (len(lines), len(lines) - len(kept), sha("\n".join(kept)))
    assert any(r["n_dropped"] for r in got.values())


def test_bitmaps_list_only_words_that_drop(spark):
    rows = [(d, "\n".join(f"own {d} {i}" for i in range(150)) + "\nshared", "s") for d in range(10)]
    maps = keep_bitmaps(frame(spark, rows)).collect()
    assert len(maps) == 10
    assert all([(k["word"], k["bits"]) for k in m["keep"]] == [(2, ~(1 << 22))] for m in maps)


def test_lines_nulls_repeats_and_clashing_names(spark):
    rows = [(None, "x\ny", "s"), (1, "x\ny", "s"), (1, "x\ny", "s"), (1, "x\nz", None)] + [(d, "x", "s") for d in range(2, 12)]
    docs = frame(spark, rows).withColumn("tid", F.lit("mine")).withColumn("n_dropped", F.lit(5)).withColumn("keep", F.lit(1))
    out = drop_common_lines(docs)
    assert out.columns == docs.columns
    texts = Counter((r["doc_id"], r["text"], r["n_chars"], r["tid"], r["n_dropped"]) for r in out.collect())
    assert texts[(None, "y", 1, "mine", 5)] == 1 and texts[(1, "y", 1, "mine", 5)] == 2 and texts[(1, "z", 1, "mine", 5)] == 1
    assert op3(docs).count() == len(rows)


def test_lines_empty_table(spark):
    assert op3(frame(spark, [])).collect() == []


def statistics(text):
    text = text or ""
    ws = words(text)
    windows = Counter(tuple(ws[i:i + 3]) for i in range(len(ws) - 2))
    covered = {q for i in range(len(ws) - 2) if windows[tuple(ws[i:i + 3])] > 1 for q in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if words(x)]
    failed = len(ws) < 50 or 100 * len(covered) > 50 * len(ws)
    return (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed)


def test_rules_against_brute_force(spark):
    rows = corpus(docs=80) + [(5000 + i, "nav | menu # top\n" * 4 + "footer <b>\n" + ("tail words " * 5 if i % 2 else f"own {i} "), "host") for i in range(12)]
    rows += [(6000 + i, " ".join(f"u{i}x{j}" for j in range(60)) + "\nnav | menu # top", "host") for i in range(12)]
    docs = {}
    for _, t, s in rows:
        docs.setdefault(s, set()).add(t or "")
    holders = {s: Counter(k for t in ts for k in {key(x) for x in t.split("\n") if words(x)}) for s, ts in docs.items()}
    got = by_id(op6(frame(spark, rows)))
    assert len(got) == len(rows)
    for d, t, s in rows:
        want = statistics(t)
        lost = sum(len(words(x)) for x in (t or "").split("\n")
                   if words(x) and holders[s][key(x)] >= 10 and holders[s][key(x)] >= len(docs[s]) ** 0.5)
        assert tuple(got[d])[1:7] == want, d
        assert got[d]["kept"] == (not want[-1] and not want[0] - lost < 0.3 * want[0]), d
    assert got[6000]["kept"] and got[6000]["n_left_words"] == 60


def test_depleted_documents_go_and_clashing_columns_stay(spark):
    shared = "\n".join(" ".join(f"l{k}w{j}" for j in range(9)) for k in range(8))
    rows = [(d, f"{shared}\nown line number {d}", "h") for d in range(20)] + [(99, " ".join(f"c{j}" for j in range(80)), "h")]
    docs = frame(spark, rows).withColumn("kept", F.lit("x")).withColumn("host", F.lit("y"))
    out = keep_good(docs)
    assert out.columns == docs.columns and [r["doc_id"] for r in out.collect()] == [99]


def test_a_large_host_loses_its_template_too(spark):
    """A line in 60 of 900 documents is boilerplate there (a tenth of the host would be 90), one in 25 is not;
    documents made of little else fail although their base statistics do not."""
    own = lambda d, n: " ".join(f"u{d}x{j}" for j in range(n))
    template = " ".join(f"menu{j}" for j in range(50))
    rows = [(d, f"{template}\n{own(d, 10 if d < 30 else 60)}" if d < 60 else f"{own(d, 60)}\nonly twenty five" if d < 85 else own(d, 60), "big")
            for d in range(900)]
    got = by_id(op6(frame(spark, rows)))
    differ = {d for d, r in got.items() if r["kept"] == r["base_failed"]}
    assert differ == set(range(30)) and not any(got[d]["base_failed"] for d in differ)
    assert got[40]["kept"] and got[40]["n_left_words"] == 60 and got[70]["n_left_words"] == 63


def test_lines_above_the_limit_leave_the_kept_texts(spark):
    own = lambda d: " ".join(f"u{d}x{j}" for j in range(60))
    rows = [(d, f"Nav | Menu\n{own(d)}\n\n  nav | MENU ", "h") for d in range(12)] + [(50, f"nav | menu\n{own(50)}", "other")]
    # One id and text under two hosts: only one of them has the line above its limit.
    rows += [(7, rows[7][1], "other"), (60, own(60), "h"), (None, f"{own(61)}\nnav | menu", "h")]
    docs = frame(spark, rows)
    got = Counter((r["doc_id"], r["source"], r["text"], r["n_chars"]) for r in keep_good(docs).collect())
    left = [(d, s, "\n".join(x for x in t.split("\n") if s != "h" or key(x) != "nav | menu")) for d, t, s in rows]
    assert got == Counter((d, s, t, len(t)) for d, s, t in left)


def test_rules_nulls_repeats_empty(spark):
    text = " ".join(f"c{j}" for j in range(80))
    out = op6(frame(spark, [(None, text, None), (None, text, None), (1, None, "s"), (2, text, "")])).collect()
    assert sorted(r["kept"] for r in out) == [False, True, True, True]
    assert op6(frame(spark, [])).count() == 0
    assert BLANK.split("a\x0bb") == ["a", "b"]
