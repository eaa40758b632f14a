"""Connected groups of rows that meet in buckets, without all pairs of a bucket."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.shared import checked, cut


def components(links: DataFrame) -> DataFrame:
    """(id, class_id) for every id of the links (a, b): the smallest id it is connected to.

    Alternates large-star and small-star steps until the links are stars. Each step is one
    aggregation and one join on the node, so a hub's links are counted before the shuffle and its
    join partition can be split. A step's links are kept in the checkpoint folder.
    """
    edges = cut(_both_ways(links).where("a > b").distinct())
    state = _state(edges)
    while state[0]:
        edges = cut(_small_star(_large_star(edges)))
        after = _state(edges)
        if after == state:
            break
        state = after
    return edges.select(F.col("a").alias("id"), F.col("b").alias("class_id")).union(
        edges.select("b", "b").distinct()
    )


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b"), F.col("a")))


def _state(edges: DataFrame) -> tuple:
    """Count and two order-free sums of the links."""
    row = edges.agg(
        F.count("*"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
        F.sum(F.hash("a", "b").cast("long")),
    ).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    around = _both_ways(edges)
    least = around.groupBy("a").agg(F.min("b").alias("m"))
    least = least.withColumn("m", F.least("a", "m"))
    joined = around.where("b > a").join(least, "a")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m"))
    return joined.union(least).toDF("a", "b").distinct()


def classes(
    buckets: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    verify_blocks: Callable[[DataFrame], DataFrame] | None = None,
    big: int = 32,
    verify_rest: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """(id, class_id) for the ids of buckets (id, key) that are linked to another.

    `verify` cuts pairs (a, b) down to links. Every pair that shares a bucket is either verified
    or already connected: first each row with the smallest of its bucket, which connects a group
    of copies with as many pairs as rows; then, in buckets where more than one connected group
    is left, the pairs across these groups. In buckets of more than `big` rows `verify_blocks`
    looks for these instead: it gets (key, id, class_id, n) and gives links that connect what is
    linked, without a row for every pair. `verify_rest` may verify the pairs across groups in the
    other buckets: few of them are links, where many of the first are.
    """
    shared = cut(
        buckets.groupBy("key")
        .agg(F.min("id").alias("hub"), F.max("id").alias("top"), F.count("*").alias("n"))
        .where("hub < top")
    )
    crowded = cut(shared.where("n > 2").select("key", "hub", "n"))
    members = cut(buckets.join(checked(crowded), "key"))
    tried = cut(
        shared.where("n = 2")
        .select(F.col("hub").alias("a"), F.col("top").alias("b"))
        .union(members.where("id != hub").select("hub", "id"))
        .distinct()
    )
    links = cut(verify(tried))
    label = components(links)
    placed = cut(
        members.select("key", "id", "n")
        .join(label, "id", "left")
        .withColumn("class_id", F.coalesce("class_id", "id"))
    )
    mixed = cut(
        placed.groupBy("key")
        .agg(F.min("class_id").alias("low"), F.max("class_id").alias("high"))
        .where("low < high")
        .select("key")
    )
    if mixed.isEmpty():
        return label
    rest = cut(placed.join(checked(mixed), "key"))
    few = rest if verify_blocks is None else rest.where(F.col("n") <= big)
    left = few.select("key", F.col("id").alias("x"), F.col("class_id").alias("x_class"))
    right = few.select("key", F.col("id").alias("y"), F.col("class_id").alias("y_class"))
    across = (
        left.join(right, "key")
        .where("x_class < y_class")
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        .distinct()
        .join(tried, ["a", "b"], "left_anti")
    )
    more = cut((verify_rest or verify)(cut(across)))
    if verify_blocks is not None:
        many = rest.where(F.col("n") > big).select("key", "id", "class_id", "n")
        if not many.isEmpty():
            more = more.union(cut(verify_blocks(many)))
    return label if more.isEmpty() else components(links.union(more))
