from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import corpus, frame, prose, words
from tests.llm.test_dedup import classes
from tests.llm.test_line_and_rules import key, statistics
from tests.llm.test_mixing_and_chat import targets
from tests.llm.test_text_scans import contamination


def brute_force(rows, items):
    """The stages before mixing, in plain Python (no line here is above a host's limit)."""
    rows = [r for r in rows if not statistics(r[1])[-1]]
    holders = {}
    for d, t, _ in rows:
        for k in {key(x) for x in t.split("\n")}:
            holders.setdefault(k, set()).add(d)
    rows = [(d, "\n".join(x for x in t.split("\n") if not key(x) or len(holders[key(x)]) < 10), s) for d, t, s in rows]
    kept = set(classes(rows).values())
    rows = [r for r in rows if r[0] in kept]
    hits = contamination(rows, items)
    return rows, hits


def test_pipeline_against_brute_force(spark, tmp_path):
    item = prose("secret", 30)
    rows = [(d, (t or "") + (f"\nALL rights reserved.\n{prose(d, 60)}" if d % 2 else ""), f"s{d}") for d, t, _ in corpus(docs=100)]
    rows += [(9000, f"{prose('a', 70)} {item} {prose('b', 70)}", "s1"), (9001, None, None)]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    want, hits = brute_force(rows, [(1, item)])
    got = corpus_pipeline.run(spark, str(tmp_path)).toPandas().set_index("doc_id")
    assert set(got.index) <= {d for d, _, _ in want}
    sizes = {}
    for d, t, s in want:
        left = len(words(t)) - hits[d][1]
        sizes[s] = sizes.get(s, 0) + left
    assert hits[9000][4] and item not in got.loc[9000, "text"]
    goal = targets(sizes)
    for d, t, s in want:
        assert hits[d][4] or d not in got.index or got.loc[d, "text"] == t
    by_source = got.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    for s, row in by_source.iterrows():
        assert abs(row.target - goal[s]) < 1e-6 * max(1, goal[s]) and abs(row.taken - goal[s]) <= 2 + 0.05 * goal[s]


def test_stages_keep_extra_columns_and_take_empty_tables(spark, tmp_path):
    spark.createDataFrame([(1, "some benchmark item")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    names = ["row", "d", "t", "tid", "words", "lines", "clean", "spans", "digest", "host", "h", "keep", "_d"]
    for rows in ([], [(1, prose(1, 80), "s"), (1, prose(1, 80), "s"), (None, prose(2, 80), None)]):
        docs = frame(spark, rows)
        for n in names:
            docs = docs.withColumn(n, F.lit(n))
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == columns, name
        assert docs.count() == min(2, len(rows))
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == min(2, len(rows))
