"""Keyed upsert, version history and schema evolution without a row-level table format.

``merge_frames`` has MERGE semantics (matched -> update some columns, unmatched
update -> insert, untouched target rows kept) as one full outer equi-join.
``upsert_partitioned`` persists it by rewriting only the partitions the updates
touch (dynamic partition overwrite). Where a table format with MERGE INTO is
available (Iceberg, Delta), use that instead; this path has no isolation between
concurrent writers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airindex.session import remove_path, scratch_path

PART = "key_part"
IN_TARGET = "_in_target"
IN_UPDATES = "_in_updates"
REJECT = "_reject"


def _any_null(keys: Sequence[str]) -> Column:
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return cond


def null_key_rows(updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that can never match (a NULL key part): route them to a reject table."""
    return updates.filter(_any_null(keys))


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: str | None = None) -> DataFrame:
    """One row per key: greatest ``order_by`` wins, ties (and no order) by the greatest row.

    The winner never depends on the order of rows. A grouped ``max_by`` is combined
    map-side, so a key holding a large share of the rows is reduced before the shuffle
    rather than sorted in one task. (Spark plans a ``max_by`` of a struct as a sort
    aggregate: each task sorts its own rows by key first.)
    """
    cols = [c for c in df.columns if c not in keys]
    if not cols:
        return df.dropDuplicates(list(keys))
    row = F.struct(*[F.col(c) for c in cols])
    if order_by:
        # Rows with a NULL order value lose to any non-NULL one but are never dropped.
        pick = F.max_by(row, F.struct(F.col(order_by).isNotNull(), F.col(order_by), row))
    else:
        pick = F.max(row)
    return df.groupBy(*keys).agg(pick.alias("_row")).select(*keys, "_row.*")


def _check_types(target: DataFrame, updates: DataFrame) -> None:
    have = {f.name: f.dataType for f in target.schema}
    for f in updates.schema:
        if f.name in have and have[f.name] != f.dataType:
            raise ValueError(f"column {f.name} is {have[f.name].simpleString()} in the table and "
                             f"{f.dataType.simpleString()} in the updates")


def with_columns_of(df: DataFrame, schema) -> DataFrame:
    """df with the columns of ``schema`` that it lacks, as NULLs."""
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in df.columns}
    return df.withColumns(missing) if missing else df


def merge_frames(target: DataFrame, updates: DataFrame, keys: Sequence[str],
                 update_cols: Sequence[str] | None = None, order_by: str | None = None,
                 dedupe: bool = True) -> DataFrame:
    """MERGE of ``updates`` into ``target`` on ``keys`` (target's column order).

    Matched rows take ``update_cols`` (default: every non-key column) from the
    update and keep the rest; unmatched updates are inserted whole; NULL-key
    updates are dropped here (see ``null_key_rows``). Duplicate keys in the
    updates are reduced to one (``order_by`` latest wins) when ``dedupe``.
    """
    keys = list(keys)
    value_cols = [c for c in target.columns if c not in keys]
    update_cols = list(update_cols) if update_cols is not None else value_cols
    good = updates.filter(~_any_null(keys))
    if dedupe:
        extra = [order_by] if order_by and order_by not in target.columns else []
        good = latest_per_key(good.select(*target.columns, *extra), keys, order_by)
    upd = good.select(*target.columns)
    t = target.withColumn(IN_TARGET, F.lit(True)).alias("t")
    u = upd.withColumn(IN_UPDATES, F.lit(True)).alias("u")
    cond = [F.col(f"t.{k}") == F.col(f"u.{k}") for k in keys]
    joined = t.join(u, cond, "full_outer")
    matched_u = F.col(f"u.{IN_UPDATES}").isNotNull()
    in_t = F.col(f"t.{IN_TARGET}").isNotNull()
    out = []
    for c in target.columns:
        tc, uc = F.col(f"t.{c}"), F.col(f"u.{c}")
        if c in keys:
            out.append(F.when(in_t, tc).otherwise(uc).alias(c))
        elif c in update_cols:
            out.append(F.when(matched_u, uc).otherwise(tc).alias(c))
        else:
            out.append(F.when(in_t, tc).otherwise(uc).alias(c))
    return joined.select(*out)


def replace_by_key(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert when updates replace whole rows: ``target`` anti-join ``updates``, union updates."""
    upd = updates.select(*target.columns)
    return target.join(upd.select(*keys), list(keys), "left_anti").unionByName(upd)


def upsert_partitioned(spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str],
                       partition_col: str, update_cols: Sequence[str] | None = None,
                       order_by: str | None = None, schema=None, parts: int | None = None) -> DataFrame:
    """Merge ``updates`` into the parquet table at ``path``, rewriting touched partitions only.

    ``parts`` deals every partition out into so many sub-folders by a hash of the other keys (column
    ``key_part``): one late row rewrites its part of a day and not the whole day. A table keeps the
    number it was made with.

    Columns only the table has keep their stored values (NULL in inserted rows); columns
    only the updates have are added to the table (NULL in rows that are not updated, unless
    ``update_cols`` leaves them out). A column of another type fails before anything is written.

    The updates are written once, marked as usable or rejects, to the shared checkpoint folder.
    Their partition values (days: bounded by the calendar) prune the target read. Where
    nothing is there to merge with, the updates are written straight to the table; otherwise the
    merged partitions are staged once, so the write never reads the files it replaces. A target
    with repeated keys fails, since a merge would multiply them. Returns the NULL-key
    rejects, read from the written updates (below ``spark.checkpoint.dir``); without rejects
    nothing is left there.
    """
    keys = list(keys)
    if partition_col not in keys:
        keys = keys + [partition_col]
    staged = scratch_path(spark, "upsert")
    merged_at = f"{staged}/merged"
    folders = [partition_col]
    if parts:
        folders.append(PART)
        updates = updates.withColumn(PART, F.pmod(F.xxhash64(*[k for k in keys if k != partition_col]), F.lit(parts)).cast("int"))
        keys = keys + [PART]
        schema = None if schema is None else T.StructType([*schema.fields, T.StructField(PART, T.IntegerType())])
    # One pass over the upstream plan: the rows, marked as rejects or not.
    marked = updates.withColumn(REJECT, _any_null(keys))
    marked.write.partitionBy(REJECT).parquet(f"{staged}/source")
    source = spark.read.schema(marked.schema).parquet(f"{staged}/source")
    rejects = source.filter(REJECT).drop(REJECT)
    usable = source.filter(~F.col(REJECT)).drop(REJECT)
    touched = [tuple(r) for r in usable.select(*folders).distinct().collect()]
    good = latest_per_key(usable, keys, order_by).select(*updates.columns)
    if not touched:
        return rejects.drop(PART)
    target = _table_part(spark, path, folders, touched, schema)
    if target is None:
        merged = good
    else:
        _check_types(target, good)
        _check_unique(target, keys, path)
        changing = [c for c in good.columns if c not in keys] if update_cols is None else list(update_cols)
        # Columns new to the table always come from the updates.
        changing += [c for c in good.columns if c not in target.columns and c not in changing]
        columns = with_columns_of(target, good.schema)
        merged = merge_frames(columns, with_columns_of(good, columns.schema), keys, changing, dedupe=False)
        merged.write.parquet(merged_at)
        merged = spark.read.schema(merged.schema).parquet(merged_at)
    (merged.hint("rebalance", *folders).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*folders).parquet(path))
    remove_path(spark, merged_at)
    if rejects.isEmpty():
        remove_path(spark, staged)
        return spark.createDataFrame([], updates.schema).drop(PART)
    return rejects.drop(PART)


def _table_part(spark: SparkSession, path: str, folders: list[str], values: list[tuple], schema) -> DataFrame | None:
    """The rows of the touched partitions; None where the table or all of them are absent."""
    try:
        # The stored columns, which may be more than ``schema`` names (files of several ages).
        table = spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    if schema is not None:
        kinds = {f.name: f.dataType for f in schema}
        table = table.select(*[F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c)
                               for c in table.columns])
    if any(c not in table.columns for c in folders):
        raise ValueError(f"{path} is not partitioned by {folders}")
    part = table.filter(F.col(folders[0]).isin([v[0] for v in values]))
    if len(folders) > 1:
        # Days with the same touched parts as one condition, so that it stays short.
        of_day: dict = {}
        for day, key_part in sorted(values):
            of_day.setdefault(day, []).append(key_part)
        by_parts: dict[tuple, list] = {}
        for day, some in of_day.items():
            by_parts.setdefault(tuple(some), []).append(day)
        cond = F.lit(False)
        for some, days in by_parts.items():
            cond = cond | (F.col(folders[0]).isin(days) & F.col(folders[1]).isin(list(some)))
        part = part.filter(cond)
    return None if part.isEmpty() else part


def _check_unique(target: DataFrame, keys: Sequence[str], path: str) -> None:
    twice = target.groupBy(*keys).count().filter("count > 1").select(*keys).first()
    if twice is not None:
        raise ValueError(f"{path} holds the key {tuple(twice)} more than once")


def merge_into_table(updates: DataFrame, table: str, keys: Sequence[str],
                     update_cols: Sequence[str] | None = None, order_by: str | None = None):
    """Upsert into a catalog table that supports row-level operations (Iceberg, Delta).

    Same semantics as ``merge_frames``: NULL-key updates are left out (returned),
    duplicates are reduced to the latest row per key first (a MERGE with several
    source rows for one target row is an error), matched rows take ``update_cols``
    (default: all non-key columns), unmatched rows are inserted whole. Tables
    without row-level support raise ``UNSUPPORTED_FEATURE``; use
    ``upsert_partitioned`` for plain parquet folders.
    """
    keys = list(keys)
    good = latest_per_key(updates.filter(~_any_null(keys)), keys, order_by)
    cols = [c for c in good.columns if c not in keys]
    update_cols = list(update_cols) if update_cols is not None else cols
    src = good.alias("s")
    cond = None
    for k in keys:
        c = F.col(f"{table}.{k}") == F.col(f"s.{k}")
        cond = c if cond is None else cond & c
    (src.mergeInto(table, cond)
     .whenMatched().update({c: F.col(f"s.{c}") for c in update_cols})
     .whenNotMatched().insertAll()
     .merge())
    return null_key_rows(updates, keys)


def as_of(log: DataFrame, keys: Sequence[str], version: int, version_col: str = "version",
          deleted_col: str | None = None) -> DataFrame:
    """State of an append-only change log as of ``version``: latest row per key."""
    state = latest_per_key(log.filter(F.col(version_col) <= F.lit(version)), keys, version_col)
    if deleted_col:
        state = state.filter(~F.coalesce(F.col(deleted_col), F.lit(False)))
    return state


def evolve_union(*frames: DataFrame) -> DataFrame:
    """Union by column name; columns missing on one side become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def affected_dates(updates: DataFrame, reach_days: int = 1, day: str = "measure_date",
                   keys: Sequence[str] = ("location_id",)) -> DataFrame:
    """Days whose daily results change when ``updates`` land: each day and the next
    ``reach_days`` (the rolling window reaches back into the previous day)."""
    d = F.col(day)
    shifted = F.explode(F.array(*[F.date_add(d, k) for k in range(0, reach_days + 1)]))
    return (updates.select(*keys, d.alias(day)).distinct()
            .select(*keys, shifted.alias(day)).distinct())
