"""Consecutive row ids without sorting the whole table in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Key values to a block of rows, and blocks to a block of blocks, as powers of two. Rows are dealt
#: to tasks by small blocks, so that many tasks number them; sizes of blocks are few and short.
BLOCK_BITS, _PARENT_BITS = 8, 16


def with_row_ids(
    rows: DataFrame,
    key: str,
    then_by: list[str],
    after: int = 0,
    alias: str = "id",
    block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """Number the rows in the order of `key` (an integer) and `then_by`, from `after` + 1.

    Rows are numbered inside blocks of 2**`block_bits` key values, and each block starts where the
    ones before it end. The block is a function of the key, so a recomputed task gives the same
    ids, and so does any size of blocks. With (`key`, `then_by`) unique, a block holds at most
    2**`block_bits` times the values of `then_by` per key, however many source rows stood behind
    one key.
    """
    bits = 64 if isinstance(rows.schema[key].dataType, T.LongType) else 32
    blocked = rows.withColumn("__block", _block_of(F.col(key), block_bits)).repartition("__block")
    # Counted with a condition on all columns that always holds, so that the sizes and the
    # numbers come from the same exchange and the rows are computed once.
    every = F.hash(*rows.columns) >= F.lit(-(2**31))
    sizes = blocked.groupBy("__block").agg(F.count_if(every).alias("__size"))
    # A null-safe match adds no condition to either side, which would tell the two apart.
    starts = _starts(sizes, bits - block_bits).withColumnRenamed("__block", "__of")
    inside = Window.partitionBy("__block").orderBy(
        key, *[F.col(c).asc_nulls_last() for c in then_by]
    )
    return (
        blocked.withColumn("__rank", F.row_number().over(inside))
        .join(starts, F.col("__block").eqNullSafe(F.col("__of")))
        .select(
            (F.col("__start") + F.col("__rank") + F.lit(after)).cast("bigint").alias(alias),
            *rows.columns,
        )
    )


def _starts(sizes: DataFrame, bits: int) -> DataFrame:
    """How many rows lie in the blocks before each block. Block numbers of more than 16
    bits are grouped once more; the last level has at most 2**16 rows, which is the only
    window without a partition."""
    if bits <= _PARENT_BITS:
        before = Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
        return sizes.select(
            "__block", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start")
        )
    grouped = sizes.withColumn("__parent", _block_of(F.col("__block"), _PARENT_BITS))
    before = (
        Window.partitionBy("__parent")
        .orderBy("__block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = grouped.withColumn("__local", F.coalesce(F.sum("__size").over(before), F.lit(0)))
    parents = _starts(
        grouped.groupBy(F.col("__parent").alias("__block")).agg(
            F.sum("__size").alias("__size")
        ),
        bits - _PARENT_BITS,
    ).select(F.col("__block").alias("__of_parent"), F.col("__start").alias("__base"))
    # Null-safe for the same reason: a condition on the parent would reach down to the rows.
    return local.join(parents, F.col("__parent").eqNullSafe(F.col("__of_parent"))).select(
        "__block", (F.col("__base") + F.col("__local")).alias("__start")
    )


def _block_of(key: Column, bits: int) -> Column:
    return F.shiftright(key.cast("bigint"), bits)
