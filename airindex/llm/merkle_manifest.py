"""Merkle dataset manifest (operator 13): levels kept as concatenated hex strings.

Every row is a leaf, a source's leaves ascend by doc_id, and runs of ``FANOUT`` nodes become their
parent until one is left: the source's subroot. The subroots, ordered by source, give the root by the
same rule. A hash is the lowercase hex SHA-256 of its inputs' hex digits.

A tree is built in rounds of aligned blocks of ``FANOUT ** BLOCK_LEVELS`` nodes. A block is one row and
keeps each of its levels as one string of digests: parents are hashes of fixed-width substrings, the
siblings on a path are the substrings flanking a node within its run. The blocks' tops are the nodes of
the next round. Places come from a range partition, so no task holds a source; a block never holds more
than ``FANOUT ** BLOCK_LEVELS`` rows, and the rounds grow with the logarithm of the table.

Nulls: a null field is ``-`` in its leaf; a null source comes before all others; null doc_ids come first
in their source and are never tampered with. Rows that repeat a doc_id are leaves of their own, ordered
by their hash. An empty text is a field of 0 bytes. An empty table has no rows and no root. Other
columns than the five are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airindex.llm.common import materialize

FANOUT = 3
BLOCK_LEVELS = 6
DIGEST = 64  # hex digits of a hash
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_LOW = (1 << 33) - 1  # monotonically_increasing_id: partition above, place in it below


def sha(x: Column) -> Column:
    return F.sha2(x, 256)


def field(value: Column) -> Column:
    """``-`` if null, else UTF-8 byte count, ``:``, value."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(*values: Column) -> Column:
    return sha(F.concat(*[field(v) for v in values]))


def placed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """nodes (with ``tree``) and each one's place in its tree, by ``order``, and the tree's size.

    Written in range-partitioned order; a place is the place in the partition plus the rows of the
    tree in earlier partitions, of which there is one small row per tree and partition.
    """
    at = F.monotonically_increasing_id()
    rows = materialize(nodes.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
                       .withColumn("at", at), "merkle-order")
    part = F.shiftright("at", 33)
    parts = rows.groupBy("tree", part.alias("part")).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    # An array per tree of its partitions, in order: at most as many as the write had.
    starts = (parts.groupBy("tree").agg(F.sort_array(F.collect_list(F.struct("part", "first", "n"))).alias("parts"),
                                        F.sum("n").alias("size"))
              .select("tree", "size", F.posexplode("parts").alias("k", "p"), "parts")
              .select("tree", F.col("p.part").alias("part"), "size",
                      (F.aggregate(F.slice("parts", F.lit(1), F.col("k")), F.lit(0).cast("long"), lambda a, x: a + x["n"])
                       - F.col("p.first").bitwiseAND(_LOW)).alias("shift")))
    return (rows.withColumn("part", part).join(starts, ["tree", "part"])
            .withColumn("place", F.col("at").bitwiseAND(_LOW) + F.col("shift")).drop("at", "part", "shift"))


def _pieces(level: Column, n: int) -> Column:
    """Fixed-width substrings of a level: ``n`` digests each, the last one shorter."""
    width = DIGEST * n
    return F.transform(F.sequence(F.lit(0), ((F.octet_length(level) - 1) / width).cast("int")),
                       lambda i: F.substring(level, i * width + 1, F.lit(width)))


def blocks_of(nodes: DataFrame, carried: list[str]) -> DataFrame:
    """Nodes (tree, size, place, digest, carried...) -> a row per aligned block: tree, size, block,
    items (array<struct<carried>> in order), level0..level6 (hex digits as bytes), levels (how many of
    them are hashed: all, but in a tree's only block those with more than one node), top."""
    span = FANOUT ** BLOCK_LEVELS
    rows = nodes.groupBy("tree", "size", F.floor(F.col("place") / span).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("place", "digest", *carried))).alias("nodes"))
    out = rows.select("tree", "size", "block", F.transform("nodes", lambda x: F.struct(*[x[c].alias(c) for c in carried] or [x["place"].alias("place")])).alias("items"),
                      F.array_join(F.transform("nodes", lambda x: x["digest"]), "").cast("binary").alias("level0"))
    for k in range(BLOCK_LEVELS):
        low = F.col(f"level{k}")
        parents = F.array_join(F.transform(_pieces(low, FANOUT), sha), "").cast("binary")
        over = (F.col("size") <= span) & (F.octet_length(low) == DIGEST)
        out = out.withColumn(f"level{k + 1}", F.when(over, low).otherwise(parents))
    hashed = sum((F.when((F.col("size") > span) | (F.octet_length(f"level{k}") > DIGEST), 1).otherwise(0)
                  for k in range(BLOCK_LEVELS)), F.lit(0))
    return out.withColumn("levels", hashed).withColumn("top", F.col(f"level{BLOCK_LEVELS}").cast("string"))


def segments(node: Column) -> Column:
    """The siblings of a block's node, level by level: array<struct<siblings, before>>."""
    steps = []
    for k in range(BLOCK_LEVELS):
        level = F.col(f"level{k}")
        at = F.floor(node / FANOUT ** k).cast("int")
        inside = at % FANOUT
        flanks = F.concat(F.substring(level, (at - inside) * DIGEST + 1, inside * DIGEST),
                          F.substring(level, (at + 1) * DIGEST + 1, (FANOUT - 1 - inside) * DIGEST))
        steps.append(F.struct(flanks.cast("string").alias("siblings"), (inside * DIGEST).alias("before")))
    return F.slice(F.array(*steps), F.lit(1), F.col("levels"))


def climb(nodes: DataFrame, carried: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """All rounds' blocks, from the nodes up, and (tree, digest) of each tree's top."""
    rounds = []
    span = FANOUT ** BLOCK_LEVELS
    while True:
        blocks = materialize(blocks_of(nodes, carried), "merkle-blocks")
        rounds.append(blocks)
        if blocks.filter(F.col("size") > span).isEmpty():
            break
        nodes, carried = blocks.select("tree", F.ceil(F.col("size") / span).cast("long").alias("size"),
                                       F.col("block").alias("place"), F.col("top").alias("digest")), []
    # A tree that was over earlier went on as one node, which nothing hashes again.
    return rounds, rounds[-1].select("tree", F.col("top").alias("digest"))


def descend(rounds: list[DataFrame], above: DataFrame, own: list[str]) -> DataFrame:
    """A row per node of the first round: tree, items' fields, digest, path (siblings up to the top,
    then ``above``'s path of the tree) and ``own`` columns of ``above`` (tree, path, own...)."""
    path_of = above.withColumnRenamed("path", "up").select("tree", "up", *own, F.lit(0).cast("long").alias("block"))
    for k in range(len(rounds) - 1, -1, -1):
        blocks = rounds[k].join(path_of, ["tree", "block"])
        count = (F.octet_length("level0") / DIGEST).cast("int")
        nodes = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.struct(
            F.get("items", i).alias("item"), F.substring(F.col("level0"), i * DIGEST + 1, F.lit(DIGEST)).cast("string").alias("digest"),
            (F.col("block") * FANOUT ** BLOCK_LEVELS + i).alias("place"), segments(i).alias("part")))
        rows = blocks.select("tree", "up", *own, F.explode(nodes).alias("node"))
        path = F.concat("node.part", "up")
        if k:
            path_of = rows.select("tree", path.alias("up"), *own, F.col("node.place").alias("block"))
        else:
            return rows.select("tree", "node.item.*", "node.digest", path.alias("path"), *own)
    raise AssertionError("no rounds")


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, start, lambda node, step: sha(F.concat(
        F.substring(step["siblings"], F.lit(1), step["before"]), node,
        F.substring(step["siblings"], step["before"] + 1, F.lit(FANOUT * DIGEST)))))


def manifest(docs: DataFrame, check: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, path, and ``check``'s value: a row per row of docs.

    ``path`` is the proof: array<struct<siblings, before>> from the leaf's run up to the root; ``before``
    is how many hex digits of the siblings come before the node. ``check`` is any column of docs to carry.
    """
    # A null source sorts below every other: its tree has the empty name.
    tree = F.coalesce(F.concat(F.lit("s"), "source"), F.lit(""))
    leaves = docs.select(tree.alias("tree"), "doc_id", leaf(*[F.col(c) for c in FIELDS]).alias("digest"),
                         (F.lit(None).cast("string") if check is None else check).alias("check"))
    rounds, subroots = climb(placed(leaves, ["doc_id", "digest"]), ["doc_id", "check"])
    subroots = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("source"), "digest")
    upper, roots = climb(placed(subroots, ["source"]), ["source"])
    none = F.array().cast("array<struct<siblings:string,before:int>>")
    above = descend(upper, roots.select("tree", none.alias("path"), F.col("digest").alias("root")), ["root"])
    above = materialize(above.select(F.col("source").alias("tree"), "path", "root", F.col("digest").alias("subroot")), "merkle-roots")
    return descend(rounds, above, ["subroot", "root"]).select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root", "path", "check")


def proof(path: Column) -> Column:
    return sha(F.array_join(F.transform(path, lambda step: step["siblings"]), ""))


def op13(docs: DataFrame) -> DataFrame:
    """The manifest; where 2 divides crc32 of the decimal doc_id, the fold starts at a tampered leaf."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    other = F.when(tampered, leaf(*[F.col(c) for c in FIELDS[:-1]], F.replace("text", F.lit("\n"), F.lit(""))))
    rows = manifest(docs, other)
    root = folded(F.coalesce("check", "leaf"), F.col("path"))
    return rows.select("doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"), root.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''),
  lambda c: ascii(c)::BIGINT)), lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
  lambda v, k: xor(v >> 1, 3988292384::BIGINT * (v & 1)))), 4294967295::BIGINT)"""


def _field_sql(x: str) -> str:
    return f"coalesce(octet_length(encode({x}::VARCHAR)) || ':' || {x}::VARCHAR, '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_field_sql(x) for x in (*FIELDS[:-1], text)) + ")"


def _tree_sql(name: str, rows: str) -> str:
    return f"""{name}(tree, level, place, n, digest) AS (
  SELECT tree, 0, place, n, digest FROM {rows}
  UNION ALL
  SELECT tree, level + 1, place // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY place))
  FROM {name} WHERE n > 1 GROUP BY tree, level, place // 3, n)"""


def _steps_sql(nodes: str, tree: str) -> str:
    """A row per node and level of its way up: the siblings before and after."""
    return f"""SELECT x.tree, x.place, t.level, coalesce(string_agg(t.digest, '' ORDER BY t.place) FILTER (t.place < x.place // (3 ** t.level)::BIGINT), '') AS before,
    coalesce(string_agg(t.digest, '' ORDER BY t.place) FILTER (t.place > x.place // (3 ** t.level)::BIGINT), '') AS after
  FROM {nodes} x JOIN {tree} t ON t.tree = x.tree AND t.n > 1 AND t.place // 3 = x.place // (3 ** (t.level + 1))::BIGINT
  GROUP BY x.tree, x.place, t.level"""


SQL = f"""WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('s' || source, '') AS tree, {_leaf_sql('text')} AS digest,
    CASE WHEN ({_CRC}) % 2 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")} END AS other FROM documents),
rows0 AS (SELECT *, row_number() OVER w - 1 AS place, count(*) OVER (PARTITION BY tree) AS n FROM leaves
  WINDOW w AS (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest)),
{_tree_sql('lower_tree', 'rows0')},
tops AS (SELECT '' AS tree, tree AS source, digest, row_number() OVER (ORDER BY encode(tree)) - 1 AS place, count(*) OVER () AS n
  FROM lower_tree WHERE n = 1),
{_tree_sql('upper_tree', 'tops')},
low_steps AS ({_steps_sql('rows0', 'lower_tree')}),
up_steps AS ({_steps_sql('tops', 'upper_tree')}),
low_paths AS (SELECT tree, place, list({{'b': before, 'a': after}} ORDER BY level) AS path FROM low_steps GROUP BY ALL),
up_paths AS (SELECT t.source AS tree, list({{'b': s.before, 'a': s.after}} ORDER BY s.level) AS path FROM up_steps s JOIN tops t ON t.place = s.place GROUP BY ALL),
proofs AS (SELECT r.doc_id, r.digest AS leaf, t.digest AS subroot, (SELECT digest FROM upper_tree WHERE n = 1) AS root,
    coalesce(r.other, r.digest) AS start, list_concat(coalesce(l.path, []), coalesce(u.path, [])) AS path
  FROM rows0 r JOIN tops t ON t.source = r.tree LEFT JOIN low_paths l ON l.tree = r.tree AND l.place = r.place LEFT JOIN up_paths u ON u.tree = r.tree),
shown AS (SELECT doc_id, leaf, subroot, root, sha256(list_aggregate(list_prepend('', list_transform(path, lambda s: s.b || s.a)), 'string_agg', '')) AS proof_sha256,
    list_reduce(list_prepend({{'b': '', 'a': start}}, path), lambda x, s: {{'b': '', 'a': sha256(s.b || x.a || s.a)}}).a AS folded_root FROM proofs)
SELECT *, folded_root = root AS verified FROM shown
"""
