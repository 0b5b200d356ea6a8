"""Embedding near-dedup (operator 12): collision counting on sorted one-dimensional projections.

Unit vectors are projected on many random directions. In each projection the vectors are sorted, and a
query meets those inside a window centred on it. Two vectors at the least similarity differ by a normal
variable of known spread, so the number of windows in which a true pair meets is binomial; pairs that
meet in fewer than a count that true pairs reach with probability ``RECALL`` are dropped, and the others
are verified by their cosine in double precision.

Windows on one line hold a fixed share of all vectors, so counting runs inside cells: each of several
tables cuts a few lead projections of its own at random offsets, and a pair is counted in the first
table where it shares a cell. Number of lead projections and tables follow from the rows of the largest
label (``tables_for``): about ``MATES`` strangers a cell, and ``RECALL`` for the tables together. A cell of
more than ``BLOCK`` vectors is dealt in tiles of two blocks each, so a crowded cell is many tasks' work; a
task streams its tiles and holds one buffer of them. Equal vectors of a label are one node from the start.
Tiles return a count per vector and the edges of a spanning forest, never their pairs.

Nulls: a null label, and a vector that is null, empty, all zeros or holds a null or non-finite component,
links with nothing: its row is its own component. Vectors of different lengths don't link. Rows that
repeat a vec_id are vectors of their own; a null vec_id never names a component of others (a component
without any other id has a null one). An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airindex.llm.common import materialize, mix
from airindex.llm.near_dup import classes_of

SIMILARITY = 0.98
PROJECTIONS, WINDOW = 32, 2.0  # counting projections; half a window, in spreads of a pair at SIMILARITY
RECALL = 0.999  # of a pair at SIMILARITY: for the count, and for the tables together
CELL = 8.0  # width of a cell, in spreads
MATES = 64
BLOCK, BUFFER = 1024, 4096
SEED = 12
SPREAD = math.sqrt(2 - 2 * SIMILARITY)


def least_count(projections: int = PROJECTIONS, window: float = WINDOW, recall: float = RECALL) -> int:
    """The largest count that a pair at SIMILARITY reaches with probability ``recall``."""
    p = math.erf(window / math.sqrt(2))
    tail = 0.0
    for count in range(projections, -1, -1):
        tail += math.comb(projections, count) * p ** count * (1 - p) ** (projections - count)
        if tail >= recall:
            return count
    return 0


def same_cell(width: float) -> float:
    """Probability that a normal difference of spread 1 stays inside a cell at a random offset."""
    return math.erf(width / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * width) * (1 - math.exp(-width * width / 2))


def tables_for(rows: int) -> tuple[int, int]:
    """(lead projections, tables) for a label of ``rows`` vectors."""
    near, far = same_cell(CELL), same_cell(CELL * SPREAD / math.sqrt(2))
    lead = max(2, math.ceil(math.log(max(rows, 1) / MATES) / -math.log(far)))
    return lead, math.ceil(math.log(1 - RECALL) / math.log(1 - near ** lead))


def directions(dim: int, n: int, use: int) -> np.ndarray:
    """dim x n random directions, the same everywhere."""
    return np.random.default_rng((SEED, dim, use)).standard_normal((dim, n))


def unit_rows(vectors: pa.Array) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Length of every vector, and for each length the rows that have it and their unit vectors."""
    offsets = vectors.offsets.to_numpy()
    values = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = np.diff(offsets)
    out = []
    for dim in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == dim)
        x = values[offsets[rows][:, None] + np.arange(dim)]
        x = x / np.abs(x).max(1, keepdims=True)  # squares neither overflow nor vanish
        out.append((rows, x / np.sqrt((x * x).sum(1, keepdims=True))))
    return lengths, out


def with_cells(nodes: DataFrame, lead: int, tables: int) -> DataFrame:
    """nodes and cells: array<long>, a cell of each table."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.empty((batch.num_rows, tables), np.int64)
            seed = batch.column("label_hash").to_numpy().view(np.uint64)
            for rows, unit in unit_rows(batch.column("embedding"))[1]:
                dim = unit.shape[1]
                places = unit @ directions(dim, lead * tables, 1)
                shift = np.random.default_rng((SEED, dim, 2)).random(lead * tables)
                steps = np.floor(places / (CELL * SPREAD) + shift).astype(np.int64).view(np.uint64).reshape(-1, tables, lead)
                cell = mix(seed[rows][:, None] + np.arange(tables, dtype=np.uint64)) + np.uint64(dim)
                for k in range(lead):
                    cell = mix(cell * np.uint64(0xD1342543DE82EF95) + steps[:, :, k])
                cells[rows] = cell.view(np.int64)
            flat = pa.FixedSizeListArray.from_arrays(pa.array(cells.ravel()), tables).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, flat], [*batch.schema.names, "cells"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema.fields)
    return nodes.mapInArrow(scan, f"{kinds}, cells array<long>")


def colliding(unit: np.ndarray, group: np.ndarray, block: np.ndarray, split: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (a, b) of rows of a group that meet in enough windows; where the group's tile is of two
    blocks (``split``), pairs across the blocks only. Rows come sorted by group."""
    n, dim = unit.shape
    half, least = WINDOW * SPREAD, least_count()
    place = unit @ directions(dim, PROJECTIONS, 0)
    room = 4 * float(np.abs(place).max(initial=1.0)) + 4 * half  # keeps the groups' lines apart
    begin = np.searchsorted(group, group)
    width = int((np.searchsorted(group, group, "right") - begin).max(initial=1))
    lines = []
    for j in range(PROJECTIONS):
        line = group * room + place[:, j]
        order = np.argsort(line, kind="stable")
        lines.append((order, np.searchsorted(line[order], line - half), np.searchsorted(line[order], line + half, "right")))
    chunk = max(1, 4_000_000 // width)
    for low in range(0, n, chunk):
        queries = np.arange(low, min(low + chunk, n))
        counts = np.zeros(len(queries) * width, np.uint8)
        for order, first, end in lines:
            many = end[queries] - first[queries]
            q = np.repeat(queries, many)
            other = order[np.repeat(first[queries] - np.cumsum(many) + many, many) + np.arange(len(q))]
            once = np.where(split[q], block[q] < block[other], q < other)
            q, other = q[once], other[once]
            counts[(q - low) * width + other - begin[q]] += 1  # a pair meets once a line
        hits = np.flatnonzero(counts >= least)
        a = hits // width + low
        yield a, hits % width + begin[a]


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest row that each row reaches over the pairs."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def tile_links(batch: pa.RecordBatch) -> pa.RecordBatch:
    """node, links (vectors linked that no earlier table has linked), root: of whole tiles, sorted."""
    columns = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in ("table", "cell", "low", "high", "block", "node", "weight")}
    new = np.ones(batch.num_rows, bool)
    new[1:] = np.any([columns[c][1:] != columns[c][:-1] for c in ("table", "cell", "low", "high")], axis=0)
    group = np.cumsum(new)
    label = batch.column("label").dictionary_encode().indices.to_numpy()
    cells = batch.column("cells").flatten().to_numpy().reshape(batch.num_rows, -1)
    earlier = np.arange(cells.shape[1])
    found_a, found_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for rows, unit in unit_rows(batch.column("embedding"))[1]:
        for a, b in colliding(unit, group[rows], columns["block"][rows], (columns["low"] < columns["high"])[rows]):
            for at in range(0, len(a), 1 << 15):
                x, y = a[at: at + (1 << 15)], b[at: at + (1 << 15)]
                close = np.einsum("ij,ij->i", unit[x], unit[y]) >= SIMILARITY
                x, y = rows[x[close]], rows[y[close]]
                seen = ((cells[x] == cells[y]) & (earlier < columns["table"][x][:, None])).any(1)
                good = ~seen & (label[x] == label[y]) & (columns["node"][x] != columns["node"][y])
                found_a.append(x[good])
                found_b.append(y[good])
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    links = np.zeros(batch.num_rows, np.int64)
    np.add.at(links, a, columns["weight"][b])
    np.add.at(links, b, columns["weight"][a])
    some = np.flatnonzero(links)
    root = forest(a, b, batch.num_rows)
    return pa.RecordBatch.from_arrays([pa.array(columns["node"][some]), pa.array(links[some]), pa.array(columns["node"][root[some]])],
                                      ["node", "links", "root"])


def links_of_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buffers of whole tiles of the sorted stream -> their links."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        keys = [batch.column(c).to_numpy() for c in ("table", "cell", "low", "high")]
        turn = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1 if batch.num_rows else np.empty(0, np.int64)
        if held and batch.num_rows and any(held[-1].column(c)[-1] != batch.column(c)[0] for c in ("table", "cell", "low", "high")):
            turn = np.append(0, turn)
        done = 0
        for t in turn.tolist():
            if rows + t - done >= BUFFER:
                yield tile_links(pa.concat_batches([*held, batch.slice(done, t - done)]))
                held, rows, done = [], 0, t
        held.append(batch.slice(done))
        rows += batch.num_rows - done
    if rows:
        yield tile_links(pa.concat_batches(held))


def tiles(nodes: DataFrame) -> DataFrame:
    """A row per node, table and tile of its cell, where the cell holds another: sorted within tasks."""
    spots = nodes.select("node", F.posexplode("cells").alias("table", "cell"))
    crowded = spots.groupBy("table", "cell").agg(F.count("*").alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = (spots.join(crowded, ["table", "cell"])
             .withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
             .withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .select("node", "table", "cell", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"), "block"))
    key = ["table", "cell", "low", "high"]
    return dealt.join(nodes, "node").repartition(*key).sortWithinPartitions(*key)


def near_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id: a row per row of embeddings."""
    rows = embeddings.select("vec_id", "label", "embedding")
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    usable = F.coalesce(F.col("label").isNotNull() & F.forall("embedding", number) & F.exists("embedding", lambda x: x != 0), F.lit(False))
    nodes = materialize(
        rows.filter(usable).groupBy("label", "embedding").agg(F.count("*").alias("weight"), F.min("vec_id").alias("low_id"))
        .select("label", "embedding", "weight", "low_id", F.xxhash64("label").alias("label_hash"),
                F.monotonically_increasing_id().alias("node")), "vectors")
    most = nodes.groupBy("label").count().agg(F.max("count")).collect()[0][0] or 0
    cells = materialize(with_cells(nodes.select("node", "weight", "label", "label_hash", "embedding"), *tables_for(most)).drop("label_hash"), "cells")
    found = materialize(tiles(cells).mapInArrow(links_of_tiles, "node long, links long, root long"), "links")

    classes = classes_of(found.filter("node <> root").select(F.col("root").alias("a"), F.col("node").alias("b")).distinct())
    of_class = (nodes.select("node", "low_id").join(classes, "node").groupBy("class").agg(F.min("low_id").alias("least")))
    named = classes.join(of_class, "class").select("node", "least")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = (nodes.join(counts, "node", "left").join(named, "node", "left").select(
        F.col("label").alias("of_label"), F.col("embedding").alias("of_vector"),
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.when(F.col("links").isNull(), F.col("low_id")).otherwise(F.col("least")).alias("component")))
    out = rows.withColumn("usable", usable).join(
        known, F.col("usable") & (F.col("label") == F.col("of_label")) & (F.col("embedding") == F.col("of_vector")), "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.when(F.col("usable"), F.col("component")).otherwise(F.col("vec_id")).alias("component_id"))


def op12(embeddings: DataFrame) -> DataFrame:
    return near_vectors(embeddings).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


SQL = """
WITH RECURSIVE e AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v, row_number() OVER () AS r FROM embeddings),
good AS (SELECT * FROM e WHERE label IS NOT NULL AND len(v) > 0 AND NOT list_bool_or(list_transform(v, lambda x: x IS NULL OR NOT isfinite(x)))
         AND list_bool_or(list_transform(v, lambda x: x <> 0))),
links AS (SELECT a.r AS x, b.r AS y FROM good a JOIN good b ON a.label = b.label AND a.r <> b.r AND len(a.v) = len(b.v)
          WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach(x, y) AS (SELECT r, r FROM e UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y),
least AS (SELECT reach.x AS r, min(e.vec_id) AS component_id FROM reach JOIN e ON e.r = reach.y GROUP BY 1),
counts AS (SELECT x AS r, count(*) AS n FROM links GROUP BY 1)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, l.component_id, e.vec_id IS NOT DISTINCT FROM l.component_id AS kept
FROM e JOIN least l USING (r) LEFT JOIN counts c USING (r)
"""
