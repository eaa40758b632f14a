"""Fuzzy duplicates of lines, with DataFrame operations only.

A line is normalised to its words (letters and digits, lower case, one space between them). Its
SimHash has 120 bits, the weighted majority of the hashes of its words bit by bit, in 4 blocks of
30 bits. Longer words weigh more, and words of up to three letters count only in lines that have no
others, or unrelated lines would meet by their short common words. Two lines that differ in at most
3 bits agree in a whole block. An edit of one word can change many more bits, so lines also meet by
bands of least hashes (MinHash): of their pairs of neighbouring words, and in lines of at most
`SHORT` characters of their runs of 4 characters. A pair is missed when it shares no block and no
band; the README has the measured recall. Lines that share a key are compared by edit similarity,
1 - distance / length of the longer, of the whole normalised lines, and of each connected group one
occurrence in the whole table stays: the one with the smallest (doc_id, line number).

Occurrences of the same normalised line are counted before anything else, so a line that is very
common costs as much as a rare one.

Edge cases: lines without words (blank, punctuation only) are never dropped. Null and empty texts
have no lines. Rows that repeat a doc_id keep and lose the same lines. An empty table gives an
empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.grouping import classes
from tallyhouse.llm.shared import checked, cut, stored

SIMILARITY = 0.8
BLOCKS, BLOCK_BITS = 4, 30
#: Bands, and least hashes to a band, of the pairs of neighbouring words and of runs of characters.
PAIR_BANDS, GRAM_BANDS = (10, 2), (12, 3)
#: Lines up to this length also meet by their runs of so many characters.
SHORT, _GRAM = 64, 4
#: Distances up to which cheaper comparisons look first: the work grows with the limit, and most
#: pairs that are similar are so within a small one.
_LIMITS = (16, 48, 144, 432, 1296, 3888)
#: Characters to a piece of a line, at the beginning of one that both lines must have, and by which
#: pieces may have moved.
_PIECE, _ANCHOR, _DRIFT = 128, 16, 256
#: Rows to a tile of a crowded bucket; pairs of tiles are compared apart.
_TILE = 1024
#: Pairs to a partition that compares them.
_PAIRS = 4096
#: Pairs of rows of crowded buckets to a partition, of which few are compared, and most partitions.
_BLOCK_PAIRS, _MOST_PARTS = 1 << 15, 1 << 12
#: Words of a line are counted in chunks of 128, six counters of 10 bits to a sum; chunks are added
#: up two counters of 30 bits to a sum.
_CHUNK_SHIFT, _NARROW, _LANE_BITS = 7, 10, 30
_NARROW_MASK = sum(1 << _NARROW * lane for lane in range(6))
_WIDE_MASK = ((1 << _NARROW) - 1) * (1 | 1 << _LANE_BITS)
_LANE_MASK = 1 | 1 << _LANE_BITS
#: Weight of a word: the square of its letters beyond two, from 1 to this. In lines of more bytes
#: than `_GIANT` all words weigh 1, so that no counter of any string can reach 2^29.
_MOST_WEIGHT, _GIANT = 7, 1 << 28
#: Spark removes the shuffle files of a finished action.
_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Runs of ASCII that is neither letter nor digit, within a line, but for single spaces, which stay as
# they are. Others count as letters. One by one, as Java looks single characters up and tries ranges
# in turn.
_NOT_WORD = "".join(
    rf"\x{code:02X}" for code in range(128) if code != 10 and not chr(code).isalnum()
)
_NOT_WORDS = rf"[{_NOT_WORD}](?:[{_NOT_WORD}]++|(?<! ))"


def occurrences(docs: DataFrame) -> DataFrame:
    """doc_id, line number from 0, normalised line, and two hashes of it, for lines with words.

    The whole text is normalised before it is split: a filter on the split lines would have every
    line normalised twice."""
    words = F.regexp_replace(F.lower("text"), _NOT_WORDS, " ")
    lines = docs.select("doc_id", F.posexplode(F.split(words, "\n")).alias("line_no", "line"))
    return (
        lines.withColumn("line", F.trim("line"))
        .where("line != ''")
        .select(
            "doc_id",
            "line_no",
            F.xxhash64("line").alias("id"),
            F.hash("line").alias("check"),
            "line",
        )
    )


def _counted_words(lines: DataFrame) -> DataFrame:
    """id, line, and the words that count: those of more than three letters, or else all."""
    whole = F.split("line", " ")
    long = F.filter(whole, lambda word: F.length(word) > 3)
    counting = F.when(F.col("line").rlike("[^ ]{4}"), long).otherwise(whole)
    return lines.select("id", "line", counting.alias("all"))


def word_keys(lines: DataFrame) -> DataFrame:
    """id and keys of each distinct line (id, line), as an array: the blocks of its SimHash and the
    bands of least hashes of its pairs of neighbouring words. Words are taken apart once for both."""
    giant = F.octet_length("line") > _GIANT
    most = F.when(giant, F.lit(1)).otherwise(F.lit(_MOST_WEIGHT)).alias("most")
    both = F.arrays_zip(F.col("all").alias("word"), F.slice("all", 2, F.size("all")).alias("next"))
    words = _counted_words(lines).select("id", most, F.posexplode(both).alias("at", "both"))
    word, follower = F.col("both.word"), F.col("both.next")
    letters = F.length(word) - 2
    weight = F.least(F.greatest(letters * letters, F.lit(1)), F.col("most")).cast("long")
    hashed = words.select(
        "id",
        F.shiftright("at", _CHUNK_SHIFT).alias("chunk"),
        F.xxhash64(word).alias("h0"),
        weight.alias("w"),
        F.when(follower.isNotNull(), F.xxhash64(word, follower)).alias("pair"),
    )
    hashed = hashed.select("id", "chunk", "h0", F.xxhash64("h0").alias("h1"), "w", "pair")
    narrow = [
        F.sum(F.shiftrightunsigned(h, i).bitwiseAND(F.lit(_NARROW_MASK)) * F.col("w")).alias(
            f"{h}_{i}"
        )
        for h in ("h0", "h1")
        for i in range(_NARROW)
    ]
    least = _least_hashes("pair", *PAIR_BANDS)
    chunks = hashed.groupBy("id", "chunk").agg(F.sum("w").alias("n"), *narrow, *least)
    names = [f"s{i}" for i in range(2 * _LANE_BITS)]
    wide = [
        F.sum(F.shiftrightunsigned(f"{h}_{i}", _NARROW * lane).bitwiseAND(F.lit(_WIDE_MASK)))
        for h in ("h0", "h1")
        for lane in range(3)
        for i in range(_NARROW)
    ]
    turns = [f"pair_{turn}" for turn in range(math.prod(PAIR_BANDS))]
    counted = chunks.groupBy("id").agg(
        F.sum("n").alias("n"),
        *[total.alias(name) for total, name in zip(wide, names)],
        *[F.min(turn).alias(turn) for turn in turns],
    )
    # With this added, a counter of more than half of n reaches the top bit of its lane.
    lift = (F.lit(1 << _LANE_BITS - 1) - F.floor(F.col("n") / 2) - 1) * F.lit(_LANE_MASK)
    lifted = counted.select("id", lift.cast("long").alias("lift"), *names, *turns)

    def majority(half: list[str]) -> Column:
        return F.reduce(
            F.array(*half),
            F.lit(0).cast("long"),
            lambda bits, total: F.shiftleft(bits, 1).bitwiseOR(
                F.shiftrightunsigned(total + F.col("lift"), _LANE_BITS - 1).bitwiseAND(
                    F.lit(_LANE_MASK)
                )
            ),
        )

    halves = lifted.select(
        "id",
        majority(names[:_LANE_BITS]).alias("low"),
        majority(names[_LANE_BITS:]).alias("high"),
        *turns,
    )
    blocks = []
    for name in ("low", "high"):
        for part in (F.col(name), F.shiftrightunsigned(name, BLOCK_BITS)):
            bits = part.bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))
            blocks.append(bits.bitwiseOR(F.lit(len(blocks) << BLOCK_BITS)))
    alone = F.array(*blocks)
    paired = F.array(*blocks, *_band_keys("pair", "pair", *PAIR_BANDS))
    keys = F.when(F.col("pair_0").isNull(), alone).otherwise(paired)
    return halves.select("id", keys.alias("blocks"))


def gram_bands(lines: DataFrame) -> DataFrame:
    """id and the bands of least hashes of the runs of characters of short lines, as an array."""
    short = lines.where(F.length("line") <= SHORT)
    places = F.sequence(F.lit(1), F.greatest(F.length("line") - _GRAM + 1, F.lit(1)))
    grams = short.select("id", "line", F.explode(places).alias("at"))
    gram = F.substring("line", F.col("at"), F.lit(_GRAM))
    hashes = grams.select("id", F.xxhash64(gram).alias("h"))
    least = hashes.groupBy("id").agg(*_least_hashes("h", *GRAM_BANDS))
    return least.select("id", F.array(*_band_keys("h", "gram", *GRAM_BANDS)).alias("blocks"))


def _distinct(lines: DataFrame) -> DataFrame:
    return lines.groupBy("id").agg(F.min("line").alias("line"))


def simhashes(lines: DataFrame) -> DataFrame:
    """id and keys of each distinct line, as arrays in up to two rows, for lines (id, line) that may
    come more than once: the blocks of its SimHash and the bands of least hashes of its word pairs,
    and in a short line the bands of its runs of characters.

    Words are hashed where the lines were grouped; nothing but the lines is shuffled, and that once,
    short ones twice. The two are apart because one aggregation of all their columns is too large a
    method for the JVM to compile."""
    short = lines.where(F.length("line") <= SHORT)
    return word_keys(_distinct(lines)).unionAll(gram_bands(_distinct(short)))


def _least_hashes(name: str, bands: int, rows: int) -> list[Column]:
    """The least of a column of hashes in each of bands * rows orders; nulls do not count.

    An order compares the hashes after an exclusive or with a number of its own, so that nothing is
    hashed again."""
    return [
        F.min(F.col(name).bitwiseXOR(F.lit(_turn(turn)))).alias(f"{name}_{turn}")
        for turn in range(bands * rows)
    ]


def _turn(turn: int) -> int:
    """Numbers whose leading bits are spread evenly: multiples of the golden ratio."""
    value = (turn + 1) * 0x9E3779B97F4A7C15 % (1 << 64)
    return value - (1 << 64) if value >> 63 else value


def _band_keys(column: str, name: str, bands: int, rows: int) -> list[Column]:
    """A key of each band of least hashes."""
    keys = []
    for band in range(bands):
        least = [F.col(f"{column}_{turn}") for turn in range(band * rows, (band + 1) * rows)]
        keys.append(F.xxhash64(F.lit(f"{name} {band}"), *least))
    return keys


def _most_apart(left: Column, right: Column) -> Column:
    """A distance that two lines, as arrays of words, do not exceed: that of replacing words place
    by place and removing what is left over."""
    costs = F.zip_with(
        left,
        right,
        lambda a, b: F.when(a.eqNullSafe(b), F.lit(0))
        .when(a.isNull(), F.length(b) + 1)
        .when(b.isNull(), F.length(a) + 1)
        .otherwise(F.greatest(F.length(a), F.length(b))),
    )
    return F.reduce(costs, F.lit(0), lambda total, cost: total + cost)


def _pieced(left: Column, right: Column, most: Column) -> Column:
    """A distance that two lines do not exceed: the sum over pieces. The left line is cut every
    `_PIECE` characters, the right one where it has the `_ANCHOR` characters after the cut, near the
    same place; where it has not, the piece goes on. Stops once the sum is above `most`."""

    def apart(one: Column, other: Column) -> Column:
        longer = F.greatest(F.length(one), F.length(other))
        within = F.call_function("levenshtein", one, other, F.lit(_PIECE // 2))
        # Beyond the limit -1 becomes the greatest int, and one is replaced by the other.
        edits = F.least(longer, within.bitwiseAND(F.lit((1 << 31) - 1)))
        return F.when(one == other, F.lit(0)).otherwise(edits)

    def cut_again(state: Column, piece: Column) -> Column:
        at = piece * _PIECE + 1
        near = F.greatest(state["right"], state["right"] + at - state["left"] - _DRIFT)
        window = F.substring(right, near, F.lit(2 * _DRIFT + _ANCHOR))
        found = F.position(F.substring(left, at, F.lit(_ANCHOR)), window)
        to = near + found - 1
        more = apart(
            F.substring(left, state["left"], at - state["left"]),
            F.substring(right, state["right"], to - state["right"]),
        )
        after = F.struct(
            at.alias("left"), to.alias("right"), (state["total"] + more).alias("total")
        )
        return F.when((state["total"] <= most) & (found > 0), after).otherwise(state)

    def with_rest(state: Column) -> Column:
        rest = apart(
            F.substring(left, state["left"], F.length(left)),
            F.substring(right, state["right"], F.length(right)),
        )
        total = state["total"]
        return F.when(total > most, total).otherwise(total + rest)

    pieces = F.floor((F.length(left) - _ANCHOR) / _PIECE).cast("int")
    begin = F.struct(F.lit(1).alias("left"), F.lit(1).alias("right"), F.lit(0).alias("total"))
    return F.reduce(F.sequence(F.lit(1), F.greatest(pieces, F.lit(1))), begin, cut_again, with_rest)


def similar(left: str, right: str, similarity: float, few: bool = False) -> Column:
    """Whether two columns of lines reach the edit similarity. If few pairs do, one comparison up to
    the whole limit is less work than the cheaper ones that look for similar lines first."""
    longer = F.greatest(F.length(left), F.length(right))
    most = F.floor(longer * (1 - similarity) + 1e-9).cast("int")
    apart = F.abs(F.length(left) - F.length(right))
    reached = F.when(apart > most, F.lit(False))
    within = F.call_function("levenshtein", F.col(left), F.col(right), most)
    if few:
        return reached.otherwise(within >= 0)
    # If one begins or ends with the other, the lengths tell the distance.
    for inside in (F.startswith, F.endswith):
        whole = inside(F.col(left), F.col(right)) | inside(F.col(right), F.col(left))
        reached = reached.when(whole, F.lit(True))
    # Lines with some words replaced are told by their words, counted from either end.
    words = F.split(left, " "), F.split(right, " ")
    for one, other in (words, [F.reverse(side) for side in words]):
        reached = reached.when(_most_apart(one, other) <= most, F.lit(True))
    # Longer lines with edits here and there are told by their pieces.
    pieced = _pieced(F.col(left), F.col(right), most) <= most
    reached = reached.when((longer > _PIECE) & pieced, F.lit(True))
    for limit in _LIMITS:
        near = F.call_function(
            "levenshtein", F.col(left), F.col(right), F.least(most, F.lit(limit))
        )
        reached = reached.when(near >= 0, F.lit(True)).when(most <= limit, F.lit(False))
    return reached.otherwise(within >= 0)


@contextmanager
def _releasing(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of an action go when it has ended. All that is read later has been
    written by then, so that nothing asks for them again."""
    before = spark.conf.get(_RELEASE)
    spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.set(_RELEASE, before)


def line_classes(found: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """id, check and class_id of the distinct lines that are linked to another, for stored
    occurrences."""
    with _releasing(found.sparkSession):
        return _line_classes(found, similarity)


def _line_classes(found: DataFrame, similarity: float) -> DataFrame:
    hashes = stored(simhashes(found.select("id", "line")))
    buckets = hashes.select("id", F.explode("blocks").alias("key"))

    def texts(ids: DataFrame) -> DataFrame:
        return found.join(checked(cut(ids)), "id").groupBy("id").agg(F.min("line").alias("line"))

    def verify(pairs: DataFrame, few: bool = False) -> DataFrame:
        lines = stored(texts(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()))
        first = lines.select(F.col("id").alias("a"), F.col("line").alias("a_line"))
        second = lines.select(F.col("id").alias("b"), F.col("line").alias("b_line"))
        # Few lines are few bytes, but much work: partitions are by the number of pairs.
        parts = max(1, math.ceil(pairs.count() / _PAIRS))
        both = pairs.join(first, "a").repartition(parts, "b").join(second, "b")
        return both.where(similar("a_line", "b_line", similarity, few)).select("a", "b")

    def verify_rest(pairs: DataFrame) -> DataFrame:
        return verify(pairs, few=True)

    def verify_blocks(members: DataFrame) -> DataFrame:
        """Links across classes in crowded buckets. A bucket is cut into tiles, a pair of tiles is
        a group, and rows meet only those whose lengths allow the similarity. Pairs are compared
        where they meet; only links leave."""
        pairs = members.agg(F.sum("n")).first()[0] // 2
        parts = min(1 + pairs // _BLOCK_PAIRS, _MOST_PARTS)
        members = members.join(stored(texts(members.select("id").distinct())), "id")
        step = F.floor(F.log(F.length("line").cast("double")) / -math.log(similarity))
        tiles = F.ceil(F.col("n") / _TILE).cast("int")
        own = F.pmod(F.xxhash64("id"), tiles).cast("int")
        placed = members.select(
            "key", "id", "class_id", "line", step.alias("step"), tiles.alias("tiles"),
            own.alias("own"),
        )
        every = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
        left = placed.select(
            "key", F.col("id").alias("a"), F.col("class_id").alias("a_class"),
            F.col("line").alias("a_line"), F.col("own").alias("tile"), "step", "tiles",
        )
        left = left.withColumn("other", every).withColumn(
            "step", F.explode(F.sequence(F.col("step") - 1, F.col("step") + 1))
        )
        right = placed.select(
            "key", F.col("id").alias("b"), F.col("class_id").alias("b_class"),
            F.col("line").alias("b_line"), F.col("own").alias("other"), "step", "tiles",
        )
        right = right.withColumn("tile", every)
        groups = ["key", "tile", "other", "step"]
        left = left.drop("tiles").repartition(parts, *groups)
        both = left.join(right.drop("tiles"), groups)
        apart = both.where("a < b and a_class != b_class")
        links = apart.where(similar("a_line", "b_line", similarity, few=True))
        return links.select("a", "b").distinct()

    linked = classes(buckets, verify, verify_blocks, verify_rest=verify_rest)
    checks = found.join(checked(cut(linked.select("id"))), "id").groupBy("id")
    return cut(
        linked.join(checks.agg(F.min(F.struct("line", "check")).alias("c")), "id").select(
            "id", F.col("c.check").alias("check"), "class_id"
        )
    )


def dropped_lines(docs: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Two tables: the lines with words of each document (doc_id, n_lines), and every dropped
    occurrence (doc_id, line_no, class_id of its line)."""
    found = stored(occurrences(docs))
    linked = line_classes(found, similarity)
    texts = found.groupBy("id", "check").agg(
        F.min(F.struct("doc_id", "line_no")).alias("first"), F.count("*").alias("n")
    )
    placed = texts.join(linked, ["id", "check"], "left")
    grouped = cut(
        placed.select(
            "id",
            "check",
            "first",
            "n",
            F.coalesce("class_id", "id").alias("class_id"),
            F.when(F.col("class_id").isNull(), F.col("check")).alias("apart"),
        ).where("n > 1 or apart is null")
    )
    kept = cut(grouped.groupBy("class_id", "apart").agg(F.min("first").alias("kept")))
    same = (grouped["class_id"] == kept["class_id"]) & grouped["apart"].eqNullSafe(kept["apart"])
    decided = cut(grouped.join(kept, same).select("id", "check", grouped["class_id"], "kept"))
    dropped = (
        found.select("doc_id", "line_no", "id", "check")
        .join(decided, ["id", "check"])
        .where(~F.struct("doc_id", "line_no").eqNullSafe(F.col("kept")))
        .select("doc_id", "line_no", "class_id")
    )
    return found.groupBy("doc_id").agg(F.count("*").alias("n_lines")), dropped


def line_report(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """A row per document: doc_id, n_lines with words, how many are dropped, and which."""
    counts, dropped = dropped_lines(docs, similarity)
    lost = dropped.groupBy("doc_id").agg(
        F.sort_array(F.collect_set("line_no")).alias("dropped_lines")
    )
    all_docs = docs.select("doc_id").distinct()
    return (
        all_docs.join(counts, all_docs["doc_id"].eqNullSafe(counts["doc_id"]), "left")
        .drop(counts["doc_id"])
        .join(lost, all_docs["doc_id"].eqNullSafe(lost["doc_id"]), "left")
        .select(
            all_docs["doc_id"],
            F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"),
            F.greatest(F.size("dropped_lines"), F.lit(0)).cast("long").alias("n_dropped"),
            F.coalesce("dropped_lines", F.array().cast("array<int>")).alias("dropped_lines"),
        )
    )


def without_duplicate_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents with the dropped lines taken out of `text`; all columns and rows stay."""
    _, dropped = dropped_lines(docs, similarity)
    lost = dropped.groupBy("doc_id").agg(F.collect_set("line_no").alias("lines"))
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    same = F.col("row.doc_id").eqNullSafe(lost["doc_id"])
    rest = F.filter(F.split("row.text", "\n"), lambda line, at: ~F.array_contains("lines", at))
    text = F.when(F.col("lines").isNull(), F.col("row.text")).otherwise(F.array_join(rest, "\n"))
    return rows.join(lost, same, "left").select(
        *[text.alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns]
    )
