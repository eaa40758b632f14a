"""The most frequent value per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top1(
    lines: DataFrame, group: list[str], value: str, alias: str, weight: str | None = None
) -> DataFrame:
    """The value that occurs most often in each group; ties go to the smallest value. With a
    weight a row stands for so many.

    Counting first combines rows before the shuffle, and the rank filter lets Spark cut
    every map task's output to one row per group, so a hot group stays small."""
    times = F.sum(weight) if weight else F.count(F.lit(1))
    counted = lines.groupBy(*group, value).agg(times.alias("__n"))
    best_first = Window.partitionBy(*group).orderBy(F.desc("__n"), F.col(value))
    return (
        counted.withColumn("__rn", F.row_number().over(best_first))
        .where("__rn = 1")
        .select(*group, F.col(value).alias(alias))
    )
