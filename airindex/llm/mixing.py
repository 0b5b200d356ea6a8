"""Mixing sources to target weights (operator 2) by Sainte-Lague apportionment.

Sizes are words. A source's target is its share of the mix by weight, held at ``max_epochs``
times its size, the excess reshared by weight (water filling). Targets are then apportioned in
equal-token blocks: blocks go to the highest quotients votes / (2 * blocks + 1), first to the
sources, then inside each source to its shards, which gives integer quotas per shard. A shard
lays its documents out in a seeded order, cuts that token line into equal blocks and selects
blocks systematically from a seeded start until its quota is met; blocks repeat (at most
``max_epochs`` times) where the quota exceeds what the shard holds. A document's ``taken`` is
the overlap of its words with the selected blocks.

Only (doc_id, source, size) travel. Shards hold about ``docs_per_shard`` documents, so a hot
source is many shards and no window sees more than one of them.

Nulls: a null text has size 0 (and is never taken); a null source is a source, ordered last;
a null doc_id is an id like any other; a repeated row is a document of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from airindex.llm.common import materialize, n_words, packed

WEIGHTS = (3, 1, 2)


def source_targets(sources: DataFrame, weights=WEIGHTS, total_share: float = 1.5,
                   max_epochs: float = 2.0) -> DataFrame:
    """``sources`` (skey, source, source_size, ...) with weight and target; a row per source."""
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    s = sources.withColumn("weight", F.element_at(
        cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    s = s.withColumn("total", total_share * F.sum("source_size").over(Window.partitionBy()))
    s = s.withColumn("limit", max_epochs * F.col("source_size")).withColumn("fills_at", F.col("limit") / F.col("weight"))
    # Sources fill up in the order of limit / weight. The water level is the first level,
    # left over by the full ones, that does not fill the next source.
    order = Window.orderBy("fills_at", F.col("source").isNull(), "source")
    before = F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    s = s.withColumn("level", (F.col("total") - before) / rest)
    s = s.withColumn("open", F.when(F.col("level") < F.col("fills_at"), F.struct("fills_at", "level")))
    level = F.min("open").over(Window.partitionBy())["level"]
    return (s.withColumn("target", F.coalesce(F.least("limit", level * F.col("weight")), "limit"))
            .drop("limit", "fills_at", "level", "open", "total"))


def sainte_lague(cells: DataFrame, votes: str, house: Column, by: list[str], key: list[str],
                 out: str) -> DataFrame:
    """Adds ``out``: each cell's integer seats of its group's house, by highest quotients.

    The divisor house / votes, rounded, is a Sainte-Lague result for a house of nearly the wanted
    size; the few seats that differ are then given to the highest next quotients, or taken from
    the lowest last ones, which is the same as handing out every seat one by one.
    """
    group = Window.partitionBy(*by)
    c = cells.withColumn("_house", house.cast("long"))
    c = c.withColumn("_q", F.coalesce(F.try_divide(F.col(votes) * F.col("_house"), F.sum(votes).over(group)), F.lit(0.0)))
    c = c.withColumn("_s", F.floor(F.col("_q") + 0.5))
    c = c.withColumn("_e", F.col("_house") - F.sum("_s").over(group)).withColumn("_n", F.count("*").over(group))
    offered = F.ceil(F.col("_q") * (F.abs("_e") + F.col("_n")) / F.greatest("_house", F.lit(1))) + 1
    more, fewer = (F.col("_e") > 0) & (F.col("_q") > 0), (F.col("_e") < 0) & (F.col("_s") > 0)
    nth = (F.when(more, F.sequence(F.col("_s"), F.col("_s") + offered))
           .when(fewer, F.sequence(F.greatest(F.col("_s") - 1 - offered, F.lit(0)), F.col("_s") - 1)))
    c = c.withColumn("_j", F.explode_outer(nth))
    quotient = F.col("_q") / (2 * F.col("_j") + 1)
    ranked = F.row_number().over(Window.partitionBy(*by).orderBy(
        F.col("_j").isNull(), F.when(F.col("_e") > 0, -quotient).otherwise(quotient), *key, "_j"))
    c = c.withColumn("_hit", (F.col("_j").isNotNull() & (ranked <= F.abs("_e"))).cast("long"))
    first = [F.first(x).alias(x) for x in cells.columns if x not in by + key]
    return (c.groupBy(*by, *key).agg(*first, (F.first("_s") + F.signum(F.first("_e")).cast("long") * F.sum("_hit")).alias(out)))


def shard_quotas(cells: DataFrame, per_group: int) -> DataFrame:
    """Adds ``quota``: each shard's integer share of its source's blocks (``source_blocks``).

    Apportioned in two steps, to groups of ``per_group`` shards and then inside each, so that no window holds all
    shards of a source.
    """
    cells = cells.withColumn("_group", F.floor(F.col("shard") / per_group))
    groups = cells.groupBy("skey", "_group").agg(F.sum("shard_size").alias("group_size"), F.first("source_blocks").alias("source_blocks"))
    groups = sainte_lague(groups, "group_size", F.col("source_blocks"), ["skey"], ["_group"], "group_blocks")
    held = cells.join(groups.select("skey", "_group", "group_blocks"), ["skey", "_group"])
    return sainte_lague(held, "shard_size", F.col("group_blocks"), ["skey", "_group"], ["shard"], "quota").drop("_group", "group_blocks")


def mix_to_weights(docs: DataFrame, weights=WEIGHTS, total_share: float = 1.5, max_epochs: int = 2, seed: int = 7,
                   docs_per_shard: int = 2048, blocks_per_shard: int = 64, shards_per_group: int = 1024) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: a row per row of docs.

    The block is a ``blocks_per_shard``-th of an average shard of the smallest source, so the
    smallest source is apportioned as finely as the others.
    """
    sizes = materialize(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")), "mix-sizes")
    shards = max(1, -(-sizes.count() // docs_per_shard))
    order = F.xxhash64(F.lit(seed), "doc_id")
    own = sizes.select(
        "doc_id", "source", "size", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("skey"),
        F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(shards)).alias("shard"), order.alias("place"))
    cells = own.groupBy("skey", "shard").agg(F.sum("size").alias("shard_size"), F.first("source").alias("source"))
    sources = cells.groupBy("skey").agg(F.sum("shard_size").alias("source_size"), F.first("source").alias("source"))
    s = source_targets(sources, weights, total_share, max_epochs)
    smallest = F.min(F.when(F.col("source_size") > 0, F.col("source_size"))).over(Window.partitionBy())
    s = s.withColumn("block", F.greatest(F.lit(1), F.coalesce(F.floor(smallest / (shards * blocks_per_shard)), F.lit(1))))
    everything = F.round(F.sum("target").over(Window.partitionBy()) / F.col("block"))
    s = sainte_lague(s.withColumn("_all", everything), "target", F.col("_all"), [], ["skey"], "source_blocks")
    s = s.select("skey", "source_size", "target", "block", "source_blocks")
    quotas = shard_quotas(cells.drop("source").join(s, "skey"), shards_per_group)
    # The shard's own equal blocks, and its quota in them.
    n = F.greatest(F.lit(1), F.round(F.col("shard_size") / F.col("block"))).cast("long")
    quotas = quotas.withColumn("n", n).withColumn("picked", F.least(
        max_epochs * F.col("n"),
        F.coalesce(F.round(F.try_divide(F.col("quota") * F.col("block") * F.col("n"), F.col("shard_size"))), F.lit(0)).cast("long")))
    quotas = quotas.withColumn("start", F.pmod(F.xxhash64(F.lit(seed + 2), "skey", "shard"), F.col("n")))
    line = Window.partitionBy("skey", "shard").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    laid = own.withColumn("end", F.sum("size").over(line))
    d = laid.join(quotas.select("skey", "shard", "shard_size", "source_size", "target", "n", "picked", "start"), ["skey", "shard"])

    def taken_before(x: Column) -> Column:
        # Blocks before block k hold (k * picked + start) div n selected ones.
        length = F.col("shard_size") / F.col("n")
        k = F.least(F.floor(x / length), F.col("n") - 1)
        upto = F.floor((k * F.col("picked") + F.col("start")) / F.col("n"))
        after = F.floor(((k + 1) * F.col("picked") + F.col("start")) / F.col("n"))
        return F.round(length * upto + (after - upto) * (x - k * length))

    taken = F.when(F.col("size") > 0, taken_before(F.col("end")) - taken_before(F.col("end") - F.col("size"))).otherwise(0)
    return d.select("doc_id", "source", "size", "source_size", F.col("target").cast("double").alias("target"),
                    F.least(taken.cast("long"), max_epochs * F.col("size")).alias("taken"))


def op2(docs: DataFrame) -> DataFrame:
    return mix_to_weights(docs.select("doc_id", "source", "text")).drop("source")


def mix_documents(docs: DataFrame, **settings) -> DataFrame:
    """The rows of docs that the mix takes words of; size, source_size, target and taken in place of
    any columns of these names.

    Rows that repeat doc_id, source and size share what the mix takes of them equally.
    """
    shares = mix_to_weights(docs, **settings).groupBy(
        F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("size").alias("_size")).agg(
        F.first("source_size").alias("source_size"), F.first("target").alias("target"),
        F.floor(F.sum("taken") / F.count("*")).alias("taken"))
    rows = packed(docs).withColumn("words", n_words(F.col("text")))
    same = (F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("row.source").eqNullSafe(F.col("_s"))
            & (F.col("words") == F.col("_size")))
    added = {"size": "words", "source_size": "source_size", "target": "target", "taken": "taken"}
    return rows.join(shares.filter("taken > 0"), same).select(
        *[F.col("row")[c].alias(c) for c in docs.columns if c not in added],
        *[F.col(c).alias(name) for name, c in added.items()])
