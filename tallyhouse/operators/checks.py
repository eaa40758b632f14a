"""Constraints as jobs: each check returns the violations, an empty frame when sound."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Of a row that `with_alike` counted: how many rows share its key.
ALIKE = "__alike"
_NULLS, _BETWEEN = "null_", ","


class ConstraintViolation(ValueError):
    """A table breaks a declared key, a required column or the merge rule."""


def check_pk(table: DataFrame, key: list[str], among: DataFrame | None = None) -> DataFrame:
    """Key values that occur more than once, with their number of rows. `among` limits the
    check to the keys in that frame: after an upsert only the keys it touched can have
    become double, and a small batch of them spares the shuffle of the whole table."""
    keys = table.select(*key)
    if among is not None:
        keys = keys.join(among.select(*key), key, "left_semi")
    return keys.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def check_not_null(table: DataFrame, required: list[str]) -> DataFrame:
    """The required columns that hold NULLs, and how many; all columns in one pass."""
    counted = table.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count"))
                    for c in required
                ]
            )
        )
    ).where("null_count > 0")


def check_source_keys(source: DataFrame, on: list[str]) -> DataFrame:
    """Keys that several source rows share. A key with a NULL matches nothing and is left out."""
    return (
        source.dropna(subset=on)
        .groupBy(*on)
        .agg(F.count(F.lit(1)).alias("source_rows"))
        .where("source_rows > 1")
    )


def check_merge_cardinality(target: DataFrame, source: DataFrame, on: list[str]) -> DataFrame:
    """Keys in the target that several source rows would overwrite."""
    return check_source_keys(source, on).join(target.select(*on), on, "left_semi")


def with_alike(rows: DataFrame, key: list[str]) -> DataFrame:
    """The rows with the number of those that have the same key, to be watched as they are written.
    A key with a NULL equals no other: such rows count 0, and are dealt by all of their columns."""
    whole = reduce(and_, [F.col(c).isNotNull() for c in key])
    others = F.when(~whole, F.hash(*rows.columns))
    same = F.count(F.lit(1)).over(Window.partitionBy(*key, others))
    return rows.withColumn(ALIKE, F.when(whole, same).otherwise(0))


def watch_of(
    required: Sequence[str] = (),
    alike: bool = False,
    month: Column | None = None,
    key: str | None = None,
) -> dict[str, Column]:
    """What to watch while rows are written: how many there are, the NULLs of required columns,
    the most rows of one key (see `with_alike`), the months that occur (see `months_seen`), the
    range of a key. Apart from the counts, a task that runs twice changes none of these, and only
    whether a count is 0 decides anything."""
    watch = {"rows": F.count(F.lit(1))}
    watch |= {_NULLS + c: F.count_if(F.col(c).isNull()) for c in required}
    if alike:
        watch["alike"] = F.coalesce(F.max(ALIKE), F.lit(0))
    if month is not None:
        watch["months"] = set_of(month)
    if key is not None:
        watch |= {"low": F.min(key), "high": F.max(key)}
    return watch


def set_of(month: Column) -> Column:
    """The different months of an aggregate as one text, as a watch can hold no list."""
    return F.array_join(F.array_sort(F.collect_set(month)), _BETWEEN)


def months_seen(found: str | None) -> list[str]:
    return found.split(_BETWEEN) if found else []


def watched_nulls(seen: dict[str, object]) -> list[dict[str, object]]:
    """The rows of `check_not_null`, from what was watched."""
    return [
        {"column_name": name.removeprefix(_NULLS), "null_count": count}
        for name, count in seen.items()
        if name.startswith(_NULLS) and count
    ]


def refuse(violations: DataFrame | list[dict[str, object]], what: str) -> None:
    """Raise when there is a violation, naming up to five."""
    if isinstance(violations, DataFrame):
        violations = [row.asDict() for row in violations.limit(5).collect()]
    if violations:
        raise ConstraintViolation(f"{what}: {violations[:5]}")
