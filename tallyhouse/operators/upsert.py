"""Natural-key upsert for tables without row-level updates: it returns the next snapshot.

A full outer join would shuffle and sort the whole target for every batch and could not
split a hot key. Instead the target is left-joined to the batch, and the batch is
anti-joined to the keys found in the target. Both joins against the target have the batch
on the build side, so a small batch is broadcast and the target is not shuffled at all;
for a large one the left and anti joins are those whose skewed partitions Spark splits.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.columns import moment

_HIT = "__hit"


def upsert(
    target: DataFrame,
    source: DataFrame,
    on: list[str],
    update: list[str],
    run_ts: dt.datetime | None = None,
    stamp: str = "load_dttm",
    only_if_changed: bool = False,
    null_safe: bool = False,
) -> DataFrame:
    """The target with the source merged into it.

    Target rows whose `on` columns equal a source row get its `update` columns; source
    rows that equal no target row are added; all other target rows are kept. With `run_ts`,
    overwritten and added rows are stamped with it; `only_if_changed` leaves a row and its
    stamp alone when no value differs. A NULL key matches nothing unless `null_safe`.
    The source must hold at most one row per key that is in the target: see
    `check_merge_cardinality`.
    """
    overwritten = overwrite(
        target, source, on, update, run_ts, stamp, only_if_changed, null_safe
    )
    added = unmatched(target, source, on, null_safe)
    if run_ts is not None:
        added = added.withColumn(stamp, moment(run_ts))
    return overwritten.unionByName(added.select(*target.columns))


def overwrite(
    target: DataFrame,
    source: DataFrame,
    on: list[str],
    update: list[str],
    run_ts: dt.datetime | None = None,
    stamp: str = "load_dttm",
    only_if_changed: bool = False,
    null_safe: bool = False,
) -> DataFrame:
    """The update half of `upsert`: matching rows are overwritten, nothing is added."""
    incoming = [*on, *[c for c in update if c not in on]]
    batch = source.select(*[F.col(c).alias(_new(c)) for c in incoming], F.lit(True).alias(_HIT))
    joined = target.join(batch, _matches(target, batch, on, null_safe), "left")

    touched = F.col(_HIT).isNotNull()
    if only_if_changed:
        touched = touched & reduce(
            or_, [~F.col(c).eqNullSafe(F.col(_new(c))) for c in update]
        )
    values = {c: F.when(touched, F.col(_new(c))).otherwise(F.col(c)) for c in update}
    if run_ts is not None:
        values[stamp] = F.when(touched, moment(run_ts)).otherwise(F.col(stamp))
    return joined.select(*[values.get(c, F.col(c)).alias(c) for c in target.columns])


def unmatched(
    target: DataFrame, source: DataFrame, on: list[str], null_safe: bool = False
) -> DataFrame:
    """The insert half of `upsert`: source rows whose key is not in the target.

    The target is first cut down to the keys that the source also has, so that the side
    built for the anti join is never larger than the source."""
    sought = source.select(*[F.col(c).alias(_new(c)) for c in on])
    known = (
        target.select(*on)
        .join(sought, _matches(target, sought, on, null_safe), "left_semi")
        .distinct()
        .select(*[F.col(c).alias(_new(c)) for c in on])
    )
    return source.join(known, _matches(source, known, on, null_safe), "left_anti")


def changed_rows(
    rows: DataFrame, before: DataFrame, on: list[str], null_safe: bool = False
) -> DataFrame:
    """The distinct rows that `before` lacks or has with other values. Rows are matched on
    the key alone, so that only the key is sorted and shuffled by; `before` is first cut
    down to the keys of the rows."""
    values = [c for c in rows.columns if c not in on]
    sought = rows.select(*[F.col(c).alias(_new(c)) for c in on])
    met = before.join(sought, _matches(before, sought, on, null_safe), "left_semi")
    old = met.select(*[F.col(c).alias(_new(c)) for c in rows.columns], F.lit(True).alias(_HIT))
    differs = reduce(or_, [~F.col(c).eqNullSafe(F.col(_new(c))) for c in values])
    return (
        rows.join(old, _matches(rows, old, on, null_safe), "left")
        .where(F.col(_HIT).isNull() | differs)
        .select(*rows.columns)
        .distinct()
    )


def latest_per_key(source: DataFrame, on: list[str], by: str) -> DataFrame:
    """One row per key: the one with the greatest `by`. Equal ones are told apart by the
    other columns, so that the choice is repeatable."""
    others = [c for c in source.columns if c not in {*on, by}]
    newest = Window.partitionBy(*on).orderBy(F.col(by).desc_nulls_last(), *others)
    return source.withColumn("__rn", F.row_number().over(newest)).where("__rn = 1").drop("__rn")


def _matches(left: DataFrame, right: DataFrame, on: list[str], null_safe: bool) -> Column:
    pairs = [(left[c], right[_new(c)]) for c in on]
    return reduce(and_, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def _new(column: str) -> str:
    return f"__new_{column}"
