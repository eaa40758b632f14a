"""Mixing sources to target weights by a low-discrepancy schedule.

The documents of a source, in the order of a hash, are cut into blocks of equal numbers of words.
The mix is a row of slots of one block each. Slot i has the golden-ratio point frac(i * phi); the
cumulative shares of the sources map it to a source, so that every stretch of the mix holds the
sources in nearly their shares. The slots of a source are ranked, and rank r takes the source's
block r, starting over at the first block after the last. The schedule meets each share up to a
few slots: surplus slots are left out, missing ones follow at the end, and a source's last slot
is cut so that it has exactly its target.

Sources by code point, null last, weigh 3, 1, 2, repeating. They share 150 % of all words; a target
stops at twice its source's size, and the excess goes to the others by weight.

Edge cases: null and empty texts have size 0 and nothing is taken of them. A null source is a
source. Rows that repeat a doc_id are documents of their own. Empty tables give empty results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.shared import cut

#: Words of a block; share of all words that is mixed; how often a source may be repeated.
BLOCK, SHARE, REPEATS = 256, 1.5, 2
WEIGHTS = (3, 1, 2)
#: The golden ratio's fraction in steps of 2^-31; odd, so points do not repeat within 2^31 slots.
_STEP, _STEPS = 1327217885, 1 << 31
_STRETCH = 1 << 16
_ROWS = 20_000
_SPACE = r"[^\x20\x09-\x0D]+"


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source (as text, null kept apart), size in words, and the place in the shuffle."""
    return docs.select(
        "doc_id",
        "source",
        F.when(F.col("source").isNull(), "1").otherwise(F.concat(F.lit("0"), "source")).alias("s"),
        _size().alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("turn"),
    )


def _size() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(_SPACE)), F.lit(0)).cast("long")


def targets(rows: DataFrame, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """s, source_size, target and the number of words to take (the target without its fraction)."""
    sizes = rows.groupBy("s").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    number = F.row_number().over(Window.orderBy("s")) - 1
    weight = F.element_at(
        F.array(*[F.lit(w) for w in WEIGHTS]), (number % len(WEIGHTS) + 1).cast("int")
    )
    most = F.lit(repeats) * F.col("source_size")
    ranked = sizes.withColumn("weight", weight).withColumn("ratio", most / F.col("weight"))
    before = Window.orderBy("ratio", "s").rowsBetween(Window.unboundedPreceding, -1)
    level = (
        F.lit(share) * F.sum("source_size").over(everything)
        - F.coalesce(F.sum(most).over(before), F.lit(0))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    levelled = ranked.withColumn("level", level)
    fits = F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everything)
    target = F.least(most.cast("double"), F.coalesce(fits * F.col("weight"), most.cast("double")))
    return levelled.withColumn("target", target).select(
        "s", "source_size", "target", F.floor("target").cast("long").alias("words")
    )


def placed(rows: DataFrame) -> DataFrame:
    """The rows with `start`: the number of words before them in their source's shuffled order.

    Each source is split by the first digits of the hash, so that no task has a whole source: the
    sums of the parts are summed first, then each part's rows."""
    count = rows.count()
    digits = max(1, math.ceil(math.log(max(count / _ROWS, 1), 16)))
    rows = rows.withColumn("part", F.substring("turn", 1, digits))
    parts = rows.groupBy("s", "part").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("s").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("s", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = (
        Window.partitionBy("s", "part")
        .orderBy("turn", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        rows.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(parts, ["s", "part"])
        .withColumn("start", F.col("base") + F.col("within"))
        .drop("part", "base", "within", "turn")
    )


def schedule(goals: DataFrame, block: int = BLOCK) -> DataFrame:
    """slot, s, pass, block and `upto` (the words of the source up to which this pass goes).

    `goals` are s, source_size and words, as from `targets`."""
    whole = F.floor(F.col("words") / F.greatest("source_size", F.lit(1))).cast("long")
    blocks = F.ceil(F.col("source_size") / block).cast("long")
    left = F.col("words") - F.col("passes") * F.col("source_size")
    needs = (
        goals.withColumn("passes", whole)
        .withColumn("blocks", blocks)
        .withColumn("needed", F.col("passes") * blocks + F.ceil(left / block).cast("long"))
        .where("needed > 0")
    )
    upto = F.sum("needed").over(Window.orderBy("s"))
    needs = cut(needs.withColumn("high", upto).withColumn("low", upto - F.col("needed")))
    total = needs.agg(F.max("high")).first()[0] or 0
    bins = max(1024, 4 * needs.count())
    spark = goals.sparkSession
    point = (F.col("slot") % _STEPS) * _STEP % _STEPS
    spots = (
        spark.range(total)
        .withColumnRenamed("id", "slot")
        .withColumn("at", F.floor(point / _STEPS * total).cast("long"))
        .withColumn("bin", _bin(F.col("at"), bins, total))
    )
    ranges = needs.select(
        "s",
        "low",
        "high",
        F.explode(
            F.sequence(_bin(F.col("low"), bins, total), _bin(F.col("high") - 1, bins, total))
        ).alias("bin"),
    )
    dealt = cut(
        spots.join(ranges, "bin")
        .where("at >= low and at < high")
        .select("slot", "s", F.floor(F.col("slot") / _STRETCH).cast("long").alias("stretch"))
    )
    counts = dealt.groupBy("s", "stretch").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("s").orderBy("stretch")
    counts = counts.select(
        "s",
        "stretch",
        F.coalesce(
            F.sum("n").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("base"),
        "n",
    )
    inside = Window.partitionBy("s", "stretch").orderBy("slot")
    ranked = (
        dealt.withColumn("nth", F.row_number().over(inside) - 1)
        .join(counts.drop("n"), ["s", "stretch"])
        .select("slot", "s", (F.col("base") + F.col("nth")).alias("rank"))
    )
    had = counts.groupBy("s").agg(F.sum("n").alias("had"))
    late = (
        needs.join(had, "s", "left")
        .withColumn("had", F.coalesce("had", F.lit(0)))
        .where("had < needed")
        .select("s", F.explode(F.sequence(F.col("had"), F.col("needed") - 1)).alias("rank"))
    )
    late = late.select(
        (F.row_number().over(Window.orderBy("rank", "s")) - 1 + F.lit(total)).alias("slot"),
        "s",
        "rank",
    )
    goal = needs.select("s", "needed", "blocks", "source_size", "words")
    passed = F.floor(F.col("rank") / F.col("blocks")).cast("long")
    return (
        ranked.union(late)
        .join(goal, "s")
        .where("rank < needed")
        .withColumn("pass", passed)
        .select(
            "slot",
            "s",
            "pass",
            (F.col("rank") % F.col("blocks")).alias("block"),
            F.least(
                F.col("source_size"), F.col("words") - F.col("pass") * F.col("source_size")
            ).alias("upto"),
        )
    )


def _bin(at: Column, bins: int, total: int) -> Column:
    return F.floor(at * bins / max(total, 1)).cast("long")


def pieces(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """The placed rows cut at block borders: block, and the piece's first and last word + 1 in
    its source's order. Rows of no words have no piece."""
    end = F.col("start") + F.col("size")
    first = F.floor(F.col("start") / block).cast("long")
    last = F.floor((end - 1) / block).cast("long")
    return (
        rows.where("size > 0")
        .withColumn("block", F.explode(F.sequence(first, last)))
        .withColumn("from", F.greatest("start", F.col("block") * block))
        .withColumn("to", F.least(end, (F.col("block") + 1) * block))
    )


def mixed(rows: DataFrame, goals: DataFrame, block: int = BLOCK) -> DataFrame:
    """The mix: slot, doc_id, source, size, start, and which words of the document the slot takes
    (`first_word`, `n_words`), for placed rows."""
    both = pieces(rows, block).join(schedule(goals, block), ["s", "block"])
    taken = F.least("to", "upto") - F.col("from")
    return both.withColumn("n_words", taken).where("n_words > 0").select(
        "slot", "s", "doc_id", "source", "size", "start",
        (F.col("from") - F.col("start")).alias("first_word"), "n_words",
    )


def taken(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row per document: doc_id, source, size, source_size, target, taken."""
    rows = cut(placed(cut(sized(docs))))
    goals = cut(targets(rows))
    mix = mixed(rows, goals, block).groupBy("s", "start", "size").agg(
        F.sum("n_words").alias("taken")
    )
    return (
        rows.join(mix, ["s", "start", "size"], "left")
        .join(goals, "s")
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        )
    )


def with_shares(docs: DataFrame) -> DataFrame:
    """The documents with mix_size, mix_source_size, mix_target and mix_taken, which replace columns
    of these names. Rows that share doc_id, source and size are numbered on both sides, so each gets
    a share of its own."""
    numbers = {name: f"mix_{name}" for name in ("size", "source_size", "target", "taken")}
    key, turn = "__mix_key", "__mix_turn"

    def keyed(rows: DataFrame, size: Column, order: str) -> DataFrame:
        parts = [F.coalesce(F.col("doc_id").cast("string"), F.lit("")), size.cast("string")]
        rows = rows.withColumn(key, F.concat_ws(":", *parts, "source"))
        alike = Window.partitionBy(key).orderBy(order)
        return rows.withColumn(turn, F.row_number().over(alike))

    shares = keyed(taken(docs), F.col("size"), "taken").select(
        key, turn, *[F.col(name).alias(shown) for name, shown in numbers.items()]
    )
    own = [c for c in docs.columns if c not in numbers.values()]
    rows = keyed(docs.select(*own), _size(), key)
    return rows.join(shares, [key, turn], "left").select(*own, *numbers.values())
