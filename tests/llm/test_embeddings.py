import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from airindex.llm import embedding_dedup
from airindex.llm.embedding_dedup import PROJECTIONS, WINDOW, least_count, op12, same_cell, tables_for

SCHEMA = "vec_id long, embedding array<float>, label int"


def linked(x, y):
    if any(v is None or not len(v) or any(e is None or not math.isfinite(e) for e in v) or not any(v) for v in (x, y)) or len(x) != len(y):
        return False
    x, y = (np.array(v, np.float32).astype(float) for v in (x, y))
    x, y = x / np.abs(x).max(), y / np.abs(y).max()
    return x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.98


def brute(rows):
    n = len(rows)
    links = [[j for j in range(n) if j != i and rows[i][2] is not None and rows[i][2] == rows[j][2] and linked(rows[i][1], rows[j][1])] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        low = min(ids) if ids else None
        out.append((rows[i][0], len(links[i]), low, rows[i][0] == low))
    return sorted(out, key=str)


def turned(rng, x, cos):
    """A vector at the given cosine."""
    y = rng.standard_normal(len(x))
    x = np.array(x) / np.linalg.norm(x)
    y -= x * (x @ y)
    return (x * cos + y / np.linalg.norm(y) * math.sqrt(1 - cos * cos)).tolist()


def vectors(seed=1, dim=32):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(40):
        x = rng.standard_normal(dim).tolist()
        rows.append((len(rows), x, i % 3))
        if i % 4 == 0:
            rows.append((len(rows), turned(rng, x, 0.99), i % 3))
            rows.append((len(rows), turned(rng, rows[-1][1], 0.988), i % 3))  # a chain
            rows.append((len(rows), turned(rng, x, 0.97), i % 3))
        if i % 8 == 1:
            rows += [(len(rows) + k, x, i % 3 if k < 4 else 7) for k in range(6)]
    near = rng.standard_normal(dim)
    rows += [(900 - k, (near + 0.02 * rng.standard_normal(dim)).tolist(), 1) for k in range(60)]
    rows += [(None, [1.0] * dim, 1), (None, [1.0] * dim, 1), (950, [2.0] * dim, 1), (951, [1e-30] * dim, 1), (951, [1e30] * dim, 1),
             (952, None, 1), (953, [], 1), (954, [0.0] * dim, 1), (955, [float("nan")] + [1.0] * (dim - 1), 1), (956, [None] + [1.0] * (dim - 1), 1),
             (957, [float("inf")] * dim, 1), (958, [1.0] * dim, None), (959, [1.0] * dim, None), (960, [1.0] * (dim - 1), 1), (961, [3.0], 1), (962, [-3.0], 1), (963, [5.0], 1)]
    return rows


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize(("block", "buffer"), [(1024, 4096), (7, 20)])
def test_links_and_components(spark, monkeypatch, block, buffer):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    monkeypatch.setattr(embedding_dedup, "BUFFER", buffer)
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("node", F.lit("clash")).withColumn("links", F.lit(None).cast("int"))
    assert got(op12(df)) == brute(rows)


def test_double_vectors_and_empty_table(spark):
    rows = [(i, [float(i % 2), 1.0 + i // 2, 0.5], 4) for i in range(8)]
    schema = SCHEMA.replace("float", "double")
    assert got(op12(spark.createDataFrame(rows, schema))) == brute(rows)
    assert op12(spark.createDataFrame([], schema)).count() == 0
    assert got(op12(spark.createDataFrame([(1, None, None)], schema))) == [(1, 0, 1, True)]


def test_recall_next_to_the_threshold(spark):
    """Pairs at cosines just above 0.98 among strangers: measured recall, none below linked."""
    rng = np.random.default_rng(3)
    rows, pairs = [], 400
    for i in range(pairs):
        x = rng.standard_normal(48).tolist()
        cos = 0.9803 if i % 2 else 0.9797
        rows += [(2 * i, x, 0), (2 * i + 1, turned(rng, x, cos), 0)]
    rows += [(10_000 + i, rng.standard_normal(48).tolist(), 0) for i in range(1500)]
    out = {r["vec_id"]: r for r in op12(spark.createDataFrame(rows, SCHEMA)).collect()}
    found = [out[2 * i + 1]["component_id"] == 2 * i for i in range(pairs)]
    assert not any(found[0::2]) and sum(found[1::2]) >= 0.98 * (pairs // 2)
    assert all(out[10_000 + i]["n_links"] == 0 for i in range(1500))


def test_calibration():
    rng = np.random.default_rng(0)
    inside = (np.abs(rng.standard_normal((20_000, PROJECTIONS))) <= WINDOW).sum(1)
    assert (inside >= least_count()).mean() > 0.998 and (inside >= least_count() + 1).mean() < 0.999
    offset, step = rng.random(200_000) * 8, rng.standard_normal(200_000)
    assert same_cell(8.0) == pytest.approx((np.floor((offset + step) / 8) == 0).mean(), abs=0.01)
    for rows in (1, 100, 10 ** 4, 10 ** 7):
        lead, tables = tables_for(rows)
        assert 1 - (1 - same_cell(8.0) ** lead) ** tables >= 0.999
