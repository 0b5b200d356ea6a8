import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from airindex.llm import merkle_manifest
from airindex.llm.merkle_manifest import FIELDS, folded, manifest, op13, proof
from tests.llm.helpers import DOCS, corpus, frame


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    """Top, and for every node its siblings (before, after) level by level."""
    level, at, paths = nodes, list(range(len(nodes))), [[] for _ in nodes]
    while len(level) > 1:
        for i, p in enumerate(paths):
            start = at[i] - at[i] % 3
            p.append(("".join(level[start:at[i]]), "".join(level[at[i] + 1:start + 3])))
            at[i] //= 3
        level = [sha("".join(level[k:k + 3])) for k in range(0, len(level), 3)]
    return level[0], paths


def brute(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    trees = {}
    for d, text, lang, source, n in rows:
        own = leaf((d, source, lang, n, text))
        start = own
        if d is not None and zlib.crc32(str(d).encode()) % 2 == 0:
            start = leaf((d, source, lang, n, None if text is None else text.replace("\n", "")))
        key = b"" if source is None else b"s" + source.encode()
        trees.setdefault(key, []).append((d is not None, d or 0, own, d, start))
    for key in trees:
        trees[key].sort(key=lambda x: x[:3])
    subs = {k: tree([x[2] for x in v]) for k, v in trees.items()}
    names = sorted(subs)
    root, upper = tree([subs[k][0] for k in names]) if names else (None, [])
    out = []
    for k, up in zip(names, upper, strict=True):
        for (_, _, own, d, node), low in zip(trees[k], subs[k][1], strict=True):
            for before, after in low + up:
                node = sha(before + node + after)
            out.append((d, own, subs[k][0], root, sha("".join(b + a for b, a in low + up)), node, node == root))
    return sorted(out, key=str)


def wide(rows):
    return [(d, t, "xx", s, None if t is None else len(t)) for d, t, s in rows]


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_manifest_is_the_plain_tree(spark):
    rows = corpus(docs=90) + [(None, "no id\n", "s1"), (None, None, None), (12, "again\n\n", "s0"), (12, "again\n\n", "s0"),
                              (-5, "negative\nid", "Ü"), (-6, "\n", "😀"), (-7, "a", "￿")]
    assert got(op13(frame(spark, rows))) == brute(wide(rows))


@pytest.mark.parametrize("levels", [1, 2])
def test_rounds_of_small_blocks(spark, monkeypatch, levels):
    """Many rounds, with trees that end in each of them, and as many sources as fill blocks."""
    monkeypatch.setattr(merkle_manifest, "BLOCK_LEVELS", levels)
    rows = [(i, f"text {i}\n", f"s{i % 31 if i > 60 else 0}") for i in range(200)]
    assert got(op13(frame(spark, rows))) == brute(wide(rows))


def test_one_leaf_and_none(spark):
    assert op13(frame(spark, [])).count() == 0
    only = op13(frame(spark, [(8, "x", "s")])).collect()[0]
    assert only["leaf"] == only["subroot"] == only["root"] == only["folded_root"] and only["verified"]
    assert only["proof_sha256"] == sha("")


def test_any_change_shows(spark):
    """A fold of any altered leaf or sibling is another root; the honest ones all verify."""
    rows = manifest(frame(spark, corpus(docs=30)).withColumn("digest", F.lit("clash")).withColumn("place", F.lit(1)))
    honest = rows.select(folded(F.col("leaf"), F.col("path")) == F.col("root")).distinct().collect()
    assert [r[0] for r in honest] == [True]
    forged = F.transform("path", lambda s: F.struct(F.translate(s["siblings"], "0123456789abcdef", "123456789abcdef0").alias("siblings"),
                                                    s["before"].alias("before")))
    assert rows.filter(folded(F.col("leaf"), forged) == F.col("root")).count() == 0
    assert rows.filter(folded(F.reverse("leaf"), F.col("path")) == F.col("root")).count() == 0
    assert rows.select(proof(F.col("path"))).distinct().count() == rows.count()


def test_very_long_text(spark):
    rows = [(2, "line\n" * 400_000, "s"), (3, None, "s")]
    assert got(op13(spark.createDataFrame(wide(rows), DOCS))) == brute(wide(rows))
