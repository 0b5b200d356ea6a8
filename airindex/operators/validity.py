"""Histories: validity intervals, and as-of joins at many instants in one job.

A change log says from when on a key has a state. Both operators need each row's neighbour in time, and a
window over a key's whole history would put a busy key into one task. Here windows run per key and time
bucket; what a bucket needs from the others (the last state before it, the first change after it) comes from
one small row per key and bucket. So a task holds a key's rows of one bucket, whatever the history's length.

No instant is compared with intervals: an as-of join sorts instants and changes of a bucket together, and
each instant takes the change before it. Rows with a NULL key or instant have no state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airindex.operators.upsert import latest_per_key

BUCKET, NEXT = "_bucket", "_next"


def _known(keys: Sequence[str], at: str) -> Column:
    cond = F.col(at).isNotNull()
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def with_next(df: DataFrame, keys: Sequence[str], at: str, unit: str = "month") -> DataFrame:
    """df (one row per key and time) with ``_next``: the key's next time, NULL for its last."""
    keys = list(keys)
    rows = df.withColumn(BUCKET, F.date_trunc(unit, at))
    firsts = rows.groupBy(*keys, BUCKET).agg(F.min(at).alias("_first"))
    later = firsts.withColumn("_after", F.lead("_first").over(Window.partitionBy(*keys).orderBy(BUCKET))).drop("_first")
    inside = F.lead(at).over(Window.partitionBy(*keys, BUCKET).orderBy(at))
    return (rows.withColumn("_inside", inside).join(later, [*keys, BUCKET])
            .withColumn(NEXT, F.coalesce("_inside", "_after")).drop("_inside", "_after", BUCKET))


def state_changes(df: DataFrame, keys: Sequence[str], at: str, state: Sequence[str], unit: str = "month") -> DataFrame:
    """The rows of a log at which the state differs from the one before: keys, at, state."""
    keys, state = list(keys), list(state)
    log = latest_per_key(df.filter(_known(keys, at)).select(*keys, at, *state), [*keys, at])
    rows = log.withColumn(BUCKET, F.date_trunc(unit, at)).withColumn("_s", F.struct(*state))
    lasts = rows.groupBy(*keys, BUCKET).agg(F.max_by("_s", at).alias("_end"))
    before = lasts.withColumn("_carry", F.lag("_end").over(Window.partitionBy(*keys).orderBy(BUCKET))).drop("_end")
    w = Window.partitionBy(*keys, BUCKET).orderBy(at)
    rows = rows.withColumn("_prev", F.lag("_s").over(w)).join(before, [*keys, BUCKET])
    prev = F.coalesce("_prev", "_carry")
    return rows.filter(prev.isNull() | ~prev.eqNullSafe(F.col("_s"))).select(*keys, at, *state)


def validity(log: DataFrame, keys: Sequence[str], at: str, unit: str = "month") -> DataFrame:
    """log as intervals: its columns (``at`` as valid_from) and valid_to, exclusive; NULL while it lasts.

    Changes of one key at one time are reduced to the greatest row; rows without key or time are left out.
    """
    keys = list(keys)
    one = latest_per_key(log.filter(_known(keys, at)), [*keys, at])
    out = with_next(one, keys, at, unit)
    rest = [c for c in log.columns if c not in keys and c != at]
    return out.select(*keys, *rest, F.col(at).alias("valid_from"), F.col(NEXT).alias("valid_to"))


def as_of_join(rows: DataFrame, log: DataFrame, keys: Sequence[str], instant: str, at: str, unit: str = "month",
               prefix: str = "") -> DataFrame:
    """Each row of ``rows`` with the state of its key at its ``instant``: the last change at or before it.

    ``log``'s columns other than the keys follow, named with ``prefix`` (NULL where there is no such change).
    """
    keys = list(keys)
    one = latest_per_key(log.filter(_known(keys, at)), [*keys, at])
    rest = [c for c in log.columns if c not in keys]
    change = F.struct(*rest)
    changes = one.select(*keys, F.date_trunc(unit, at).alias(BUCKET), F.col(at).alias("_t"), change.alias("_change"))
    asked = rows.select(*keys, F.date_trunc(unit, instant).alias(BUCKET), F.col(instant).alias("_t"),
                        F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row"))
    # The state that a bucket starts with: the last change of the latest earlier bucket.
    ends = changes.groupBy(*keys, BUCKET).agg(F.max_by("_change", "_t").alias("_end"))
    marks = asked.filter(F.col(BUCKET).isNotNull()).select(*keys, BUCKET).distinct().join(ends, [*keys, BUCKET], "full")
    history = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carried = marks.withColumn("_change", F.last("_end", ignorenulls=True).over(history)).filter("_change IS NOT NULL")
    none_row = F.lit(None).cast(asked.schema["_row"].dataType)
    none_change = F.lit(None).cast(changes.schema["_change"].dataType)
    time = F.lit(None).cast(changes.schema["_t"].dataType)
    both = (carried.select(*keys, BUCKET, time.alias("_t"), F.lit(0).alias("_kind"), "_change", none_row.alias("_row"))
            .unionByName(changes.select("*", F.lit(1).alias("_kind"), none_row.alias("_row")))
            .unionByName(asked.select("*", F.lit(2).alias("_kind"), none_change.alias("_change"))))
    # Carried state first, then by time; a change counts from its own instant on.
    w = Window.partitionBy(*keys, BUCKET).orderBy(F.col("_t").asc_nulls_first(), "_kind").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_state", F.last("_change", ignorenulls=True).over(w)).filter("_kind = 2")
    state = F.when(F.col("_row")[instant].isNotNull(), F.col("_state"))
    return found.select("_row.*", *[state[c].alias(f"{prefix}{c}") for c in rest])


def gap_ranges(seen: DataFrame, keys: Sequence[str], at: str, step: str, span: tuple[Column, Column], expected: DataFrame,
               unit: str = "month") -> DataFrame:
    """Ranges of ``span`` (first and last expected time, inclusive) in which a key of ``expected`` has no row:
    keys, gap_from, gap_to (inclusive), missing (steps of ``step``, e.g. ``1 hour``).

    Missing times are never listed one by one: a gap is where the next time is more than a step away.
    """
    keys, first, last = list(keys), *span
    one = F.expr(f"INTERVAL {step}")
    rows = with_next(seen.filter(_known(keys, at)).select(*keys, at).distinct(), keys, at, unit)
    inner = rows.select(*keys, (F.col(at) + one).alias("gap_from"), (F.coalesce(NEXT, last + one) - one).alias("gap_to"))
    starts = expected.select(*keys).distinct().join(rows.groupBy(*keys).agg(F.min(at).alias("_first")), keys, "left")
    head = starts.select(*keys, first.alias("gap_from"), F.coalesce(F.col("_first") - one, last).alias("gap_to"))
    gaps = inner.join(expected.select(*keys).distinct(), keys, "left_semi").unionByName(head).filter("gap_from <= gap_to")
    seconds = F.unix_timestamp(F.timestamp_seconds(F.lit(0)) + one)
    width = F.unix_timestamp("gap_to") - F.unix_timestamp("gap_from")
    return gaps.withColumn("missing", F.call_function("div", width, seconds) + 1)
