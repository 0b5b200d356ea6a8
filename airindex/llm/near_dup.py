"""MinHash near-dedup (operator 10): BagMinHash, banding, exact verification of the multisets.

A text is the multiset of its 5-word shingles (a shorter text: one shingle of all its words). Weights
are discretised to whole levels; the levels of a shingle fall into dyadic intervals [0,1), [1,2), [2,4),
[4,8) ..., each with a Poisson process whose points carry a time, a signature slot and, inside the
interval, a level (the outcome of halving the interval down to one level). A text of weight w sees the
points below level w; every slot keeps its smallest time. Two texts agree in a slot with probability
equal to their weighted Jaccard similarity. Points come in the order of time, so a process stops at the
largest time that the signature still holds.

Signatures are banded. Texts in a common bucket are candidates if a byte of each slot agrees in at least
``AGREE`` slots (a pair at the similarity limit does so but once in about 200,000 times), and a link is a
candidate pair whose multisets overlap by ``similarity`` or more, counted exactly. Copies (equal word sequences) are one node from the
start. To find all classes without all pairs, candidates are verified in rounds: each bucket's smallest
node against the others, then a node drawn per bucket. Nodes whose buckets still hold several classes are
joined exactly across classes by the rare tokens of their multisets (``close_pairs``). Pairs inside a class
cannot change it, so the classes are those of all links.

Nulls: a null text has no words; texts without words are in no group, each row its own class. doc_id may
be null or repeated: rows with equal words are copies whatever their id. A class is named by its smallest
doc_id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airindex.llm.common import PrimeHash, materialize, mix, packed, plain_words, regroup, small_batches, text_id

SHINGLE, BANDS, ROWS = 5, 32, 5
SIMILARITY = (4, 5)  # 0.8 as a fraction: counted in whole numbers
AGREE = 104  # of BANDS * ROWS slots: 4.7 standard deviations below the 128 of a pair at the limit


def shingles(texts: pa.Array, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
    """(text, hash) of every shingle, a digest and the number of words of each text."""
    data, starts, ends, bounds = plain_words(texts)
    n = len(texts)
    words = np.diff(bounds)
    has = np.flatnonzero(words > 0)
    k_of = np.minimum(words, k)
    count = np.maximum(words - k_of + 1, 0) * (words > 0)
    of = np.repeat(np.arange(n), count)
    first = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(bounds[:-1], count)
    hashes = PrimeHash(data)(starts[first], ends[first + k_of[of] - 1]) if len(first) else np.empty(0, np.uint64)
    digests = [b""] * n
    whole = data.tobytes()
    for t, a, b in zip(has.tolist(), starts[bounds[:-1][has]].tolist(), ends[bounds[1:][has] - 1].tolist(), strict=True):
        digests[t] = hashlib.blake2b(whole[a:b], digest_size=16).digest()
    return of, hashes, digests, words


def multiset(of: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, count) of the distinct shingles."""
    order = np.lexsort((hashes, of))
    of, hashes = of[order], hashes[order]
    new = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (hashes[1:] != hashes[:-1])]) if len(of) else np.empty(0, np.int64)
    return of[new], hashes[new], np.diff(np.append(new, len(of)))


def bag_minhash(of: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int, m: int) -> np.ndarray:
    """n x m signature of times; texts without shingles keep infinity."""
    signature = np.full(n * m, np.inf)
    if len(of) == 0:
        return signature.reshape(n, m)
    # Interval 0 is [0, 1), interval b is [2^(b-1), 2^b); those that start below the weight.
    intervals = 1 + np.ceil(np.log2(weight)).astype(np.int64)
    text = np.repeat(of, intervals)
    b = np.arange(len(text)) - np.repeat(np.cumsum(intervals) - intervals, intervals)
    low = np.where(b == 0, 0, 1 << np.maximum(b - 1, 0))
    width = np.maximum(low, 1)
    seed = mix(np.repeat(shingle, intervals) + b.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
    inside = np.repeat(weight, intervals) - low  # levels of the interval below the weight
    time = np.zeros(len(text))
    table = signature.reshape(n, m)
    limit = np.full(n, np.inf)
    step = 0
    while len(text):
        # The next points of every process; several at once where few processes are left.
        count = min(64, max(1, 20_000 // len(text)))
        steps = np.arange(step + 1, step + count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        step += count
        draw = mix(seed[:, None] + steps)
        gaps = -np.log(((draw >> np.uint64(11)).astype(np.float64) + 1) * 2.0 ** -53) / width[:, None]
        # Added one by one from the time so far: the same floats however many points a step draws.
        times = np.cumsum(np.column_stack([time, gaps]), axis=1)[:, 1:]
        near = times < limit[text][:, None]
        of_point, _ = np.nonzero(near)
        place = mix(draw[near] ^ np.uint64(0x5851F42D4C957F2D))
        slot = ((place >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        level = (place & np.uint64(0xFFFFFFFF)).astype(np.int64) * width[of_point] >> 32
        seen = level < inside[of_point]
        np.minimum.at(signature, text[of_point[seen]] * m + slot[seen], times[near][seen])
        # A process whose time has passed all that its text's signature holds is over.
        touched = np.unique(text)
        limit[touched] = table[touched].max(1)
        time = times[:, -1]
        live = time < limit[text]
        text, width, seed, inside, time = text[live], width[live], seed[live], inside[live], time[live]
    return signature.reshape(n, m)


def bands(signature: np.ndarray, b: int = BANDS, r: int = ROWS) -> np.ndarray:
    """n x b bucket hashes."""
    bits = signature.view(np.uint64).reshape(len(signature), b, r)
    out = np.broadcast_to(mix(np.arange(b, dtype=np.uint64)), (len(signature), b)).copy()
    for i in range(r):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + bits[:, :, i])
    return out.view(np.int64)


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, tid, digest (empty: no words), buckets, sketch (a byte a slot): a row per row of docs."""
    small_batches(docs.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches, "text", 1 << 20):
            of, hashes, digests, _ = shingles(batch.column("text"))
            of, hashes, counts = multiset(of, hashes)
            signature = bag_minhash(of, hashes, counts, batch.num_rows, BANDS * ROWS)
            sketch = mix(signature.view(np.uint64)).view(np.int8).reshape(-1, 8)[:, 0]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tid"), pa.array(digests, pa.binary()),
                 pa.FixedSizeListArray.from_arrays(pa.array(bands(signature).ravel()), BANDS).cast(pa.list_(pa.int64())),
                 pa.FixedSizeListArray.from_arrays(pa.array(sketch.copy()), BANDS * ROWS).cast(pa.list_(pa.int8()))],
                ["doc_id", "tid", "digest", "buckets", "sketch"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_id(F.col("text")).alias("tid"), "text").mapInArrow(
        scan, f"doc_id {kind}, tid long, digest binary, buckets array<long>, sketch array<tinyint>")


def alike(a: str, b: str) -> Column:
    """Whether two sketches agree in enough slots."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)) >= AGREE


def likely(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose sketches are alike."""
    left = sketches.select(F.col("node").alias("a"), F.col("sketch").alias("sketch_a"))
    right = sketches.select(F.col("node").alias("b"), F.col("sketch").alias("sketch_b"))
    return materialize(pairs.join(left, "a").join(right, "b").filter(alike("sketch_a", "sketch_b")).select("a", "b"), "pairs")


def overlap_enough(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Whether the shingle multisets of each pair of texts overlap enough."""
    n = len(a)
    ta, ha, ca = multiset(*shingles(a)[:2])
    tb, hb, cb = multiset(*shingles(b)[:2])
    t, h, c = np.concatenate([ta, tb]), np.concatenate([ha, hb]), np.concatenate([ca, cb])
    order = np.lexsort((h, t))
    t, h, c = t[order], h[order], c[order]
    both = np.flatnonzero((t[1:] == t[:-1]) & (h[1:] == h[:-1]))
    shared = np.bincount(t[both], weights=np.minimum(c[both], c[both + 1]), minlength=n).astype(np.int64)
    total = np.bincount(t, weights=c, minlength=n).astype(np.int64)
    return shared * SIMILARITY[1] >= (total - shared) * SIMILARITY[0]


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes that are links."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches, ("text_a", "text_b"), 2 << 20):
            ok = pa.array(overlap_enough(batch.column("text_a"), batch.column("text_b")))
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(ok), batch.column("b").filter(ok)], ["a", "b"])

    return (pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
            .mapInArrow(check, "a long, b long"))


def token_rows(texts: DataFrame) -> DataFrame:
    """node, n, token: the multiset as a set, the k-th copy of a shingle being a token of its own."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regroup(batches, "text", 1 << 20):
            of, hashes, counts = multiset(*shingles(batch.column("text"))[:2])
            size = np.bincount(of, weights=counts, minlength=batch.num_rows).astype(np.int64)
            which = np.repeat(np.arange(len(of)), counts)
            copy = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
            token = mix(hashes[which] + copy.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").take(pa.array(of[which])), pa.array(size[of[which]]), pa.array(token)], ["node", "n", "token"])

    return texts.select("node", "text").mapInArrow(scan, "node long, n long, token long")


def close_pairs(texts: DataFrame, members: DataFrame) -> DataFrame:
    """(node, other) of different classes that may be links, of members (node, class): every link between
    members of different classes is among the pairs.

    Tokens are put in one order, rare ones first. Two sets that overlap by 0.8 share a token among the
    first n - ceil(0.8 n) + 1 of each, and from the place of the first token that they share on, enough
    must be left in both. A heavily edited copy begins with tokens of its own and so meets nobody. The
    classes' best members are tried first, so that members of one class are never paired.
    """
    tokens = token_rows(texts.join(members.select("node"), "node", "left_semi"))
    tokens = materialize(tokens, "tokens")
    held = tokens.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    ordered = tokens.join(held, "token").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("shared"))
    # A token that nobody else has comes first and meets nobody: only the number of them counts.
    prefix = F.expr(f"n - (n * {SIMILARITY[0]} + {SIMILARITY[1] - 1}) div {SIMILARITY[1]} + 1 - (n - size(shared))")
    firsts = materialize(ordered.filter(prefix > 0).select(
        "node", "n", (F.col("n") - F.size("shared")).alias("own"),
        F.transform(F.slice("shared", F.lit(1), prefix.cast("int")), lambda t: t["token"]).alias("firsts")), "firsts")
    heads = firsts.select("node", "n", "own", F.posexplode("firsts").alias("at", "token"))
    heads = materialize(heads.join(members, "node").select(
        "node", "class", "n", "token", (F.col("n") - F.col("own") - F.col("at")).alias("left")), "heads")

    def enough(left_a: str, n_a: str, left_b: str, n_b: str):
        most = F.least(left_a, left_b)
        return most * SIMILARITY[1] >= (F.col(n_a) + F.col(n_b) - most) * SIMILARITY[0]

    best = heads.groupBy("token", F.col("class").alias("other_class")).agg(F.max("left").alias("best"), F.min("n").alias("least"))
    hopeful = materialize(
        heads.join(best, "token").filter((F.col("class") != F.col("other_class")) & enough("left", "n", "best", "least"))
        .select("token", "other_class", "node", "n", "left"), "hopeful")
    others = (heads.withColumnRenamed("class", "other_class")
              .join(hopeful.select("token", "other_class").distinct(), ["token", "other_class"], "left_semi")
              .join(firsts.select("node", F.col("firsts").alias("other_firsts")), "node")
              .select("token", "other_class", F.col("node").alias("other"), F.col("n").alias("other_n"),
                      F.col("left").alias("other_left"), "other_firsts"))
    hopeful = hopeful.join(firsts.select("node", "firsts"), "node")
    # A pair meets at the first token that both have among their first ones, and only there.
    meet = F.get(F.array_intersect("firsts", "other_firsts"), F.lit(0)) == hopeful["token"]
    same = (hopeful["token"] == others["token"]) & (hopeful["other_class"] == others["other_class"])
    return (hopeful.join(others, same & enough("left", "n", "other_left", "other_n") & meet)
            .select("node", "other"))


def classes_of(links: DataFrame) -> DataFrame:
    """node, class of every node that has a link (a, b); class: the smallest node it is linked with.

    Every node points to its smallest neighbour below it, pointers are followed to their ends, and links
    between the ends are what the next round has: at least half of the nodes left go in each.
    """
    links = materialize(links.filter("a <> b").select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).distinct(), "links")
    rows = 2 * links.count()  # of any table below
    labels = None
    while not links.isEmpty():
        # A node without a smaller neighbour points to itself.
        points = materialize(
            links.select(F.col("high").alias("node"), F.col("low").alias("to")).union(links.select("low", "low"))
            .groupBy("node").agg(F.min("to").alias("to")), "pointers", rows)
        while True:
            jump = points.select(F.col("node").alias("to"), F.col("to").alias("far"))
            points = materialize(points.join(jump, "to").select("node", F.col("far").alias("to"), (F.col("far") != F.col("to")).alias("moved")), "pointers", rows)
            if points.filter("moved").isEmpty():
                break
        ends = points.select("node", F.col("to").alias("class"))
        labels = ends if labels is None else materialize(
            labels.withColumnRenamed("class", "was").join(ends.withColumnRenamed("node", "was"), "was", "left")
            .select("node", F.coalesce("class", "was").alias("class")), "classes", rows)
        links = materialize(
            links.join(ends.select(F.col("node").alias("low"), F.col("class").alias("low_end")), "low")
            .join(ends.select(F.col("node").alias("high"), F.col("class").alias("high_end")), "high").filter("low_end <> high_end")
            .select(F.least("low_end", "high_end").alias("low"), F.greatest("low_end", "high_end").alias("high")).distinct(), "links", rows)
    return labels if labels is not None else links.select(F.col("low").alias("node"), F.col("high").alias("class"))


def near_dup_classes(docs: DataFrame) -> DataFrame:
    """doc_id, tid, class_id, is_first: a row per row of docs.

    ``class_id``: the smallest doc_id of the class; ``is_first``: whether this is the document that
    stands for it (rows that repeat it word for word under the same id are also marked).
    """
    rows = materialize(signed(docs), "signatures")
    nodes = materialize(
        rows.filter(F.octet_length("digest") > 0).groupBy("digest")
        .agg(F.min(F.struct("doc_id", "tid", "buckets", "sketch")).alias("first"))
        .select("digest", "first.*", F.monotonically_increasing_id().alias("node")), "nodes")
    spots = nodes.select("node", F.explode("buckets").alias("bucket"))
    hubs = spots.groupBy("bucket").agg(F.min("node").alias("hub"), F.count("*").alias("n")).filter("n > 1").drop("n")
    shared = materialize(spots.join(hubs, "bucket"), "buckets")  # buckets of two nodes or more
    involved = shared.select("node").distinct()
    wanted = nodes.join(involved, "node", "left_semi").select("node", F.col("doc_id").alias("_d"), F.col("tid").alias("_t"))
    texts = materialize(
        docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("_d")) & (text_id(F.col("text")) == F.col("_t")))
        .select("node", "text").dropDuplicates(["node"]), "texts")

    sketches = materialize(nodes.join(involved, "node", "left_semi").select("node", "sketch"), "sketches")

    def linked(pairs: DataFrame) -> DataFrame:
        return materialize(verified(pairs, texts), "links")

    classes = classes_of(linked(likely(shared.filter("hub < node").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), sketches)))

    def mixed() -> DataFrame:
        """The nodes of buckets that hold two classes or more; ``drawn``: one node of the bucket."""
        spots = materialize(
            shared.select("bucket", "node").join(classes, "node", "left")
            .select("bucket", "node", F.coalesce("class", "node").alias("class")), "spots")
        of_two = spots.groupBy("bucket").agg(
            F.min("class").alias("low"), F.max("class").alias("high"),
            F.min_by(F.struct("node", "class"), F.xxhash64("node", "bucket")).alias("drawn")).filter("low < high")
        return spots.join(of_two.select("bucket", "drawn"), "bucket")

    for last in (False, True):
        if last:
            some = close_pairs(texts, materialize(mixed().select("node", "class").distinct(), "mixed"))
        else:
            some = mixed().filter(F.col("drawn.class") != F.col("class")).select("node", F.col("drawn.node").alias("other"))
        pairs = some.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
        found = linked(likely(pairs, sketches))
        if not found.isEmpty():
            # Links between classes: only what they join changes.
            of_a = classes.select(F.col("node").alias("a"), F.col("class").alias("class_a"))
            of_b = classes.select(F.col("node").alias("b"), F.col("class").alias("class_b"))
            between = found.join(of_a, "a", "left").join(of_b, "b", "left").select(
                F.coalesce("class_a", "a").alias("a"), F.coalesce("class_b", "b").alias("b"))
            known_rows = classes.count() + 2 * found.count()
            wider = materialize(classes_of(between), "classes", known_rows)
            known = classes.withColumnRenamed("class", "was").join(
                wider.select(F.col("node").alias("was"), "class"), "was", "left").select("node", F.coalesce("class", "was").alias("class"))
            classes = materialize(known.unionByName(wider.join(classes, "node", "left_anti")), "classes", known_rows)

    grouped = nodes.select("digest", "node", "doc_id", "tid").join(classes, "node", "left").withColumn("class", F.coalesce("class", "node"))
    firsts = grouped.groupBy("class").agg(F.min(F.struct("doc_id", "tid", "digest")).alias("first"))
    named = grouped.join(firsts, "class").select("digest", "first")
    out = rows.select("doc_id", "tid", "digest").join(named, "digest", "left")
    alone = F.col("first").isNull()
    return out.select(
        "doc_id", "tid", F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
        (alone | (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("tid") == F.col("first.tid")))).alias("is_first"))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """docs with one document of each near-duplicate class."""
    stays = near_dup_classes(docs).filter("is_first").select(F.col("doc_id").alias("d"), F.col("tid").alias("t")).distinct()
    kept = packed(docs).join(stays, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tid") == F.col("t")), "left_semi")
    return kept.dropDuplicates(["doc_id", "tid"]).select("row.*")


def op10(docs: DataFrame) -> DataFrame:
    return near_dup_classes(docs.select("doc_id", "text")).select("doc_id", "class_id", "is_first")


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
bags AS (SELECT doc_id, array_to_string(ws[p:p + 4], ' ') AS s, count(*) AS c
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS p FROM w WHERE len(ws) > 0) GROUP BY 1, 2),
sizes AS (SELECT doc_id, sum(c) AS n FROM bags GROUP BY 1),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, sum(least(a.c, b.c)) AS shared FROM bags a JOIN bags b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 5 * shared >= 4 * (p.n + q.n - shared)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.x, edges.y FROM reach JOIN edges ON edges.x = reach.y)
SELECT x AS doc_id, min(y) AS class_id, x = min(y) AS is_first FROM reach GROUP BY x
"""
