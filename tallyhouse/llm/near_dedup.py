"""Near duplicates by BagMinHash.

A text is the multiset of its five-word shingles. The weight axis of a shingle is cut into the
octaves [0,1), [1,2), [2,4), [4,8), ...; each octave has a Poisson process of its own, seeded by
the shingle and the octave, whose points carry a place in the octave and a slot of the signature.
A shingle of weight w owns the points whose place is below w, so a text with a larger weight owns
the same points and more. Each slot keeps its earliest point; two texts agree in a slot with the
probability of their weighted Jaccard similarity. Points are made in rising order only as far as
the slots need them.

Signatures are banded, rows that meet in a band are verified by the overlap of their multisets,
and a document of each connected group stays: the one with the smallest doc_id.

With 24 bands of 4 a pair at similarity 0.8 is missed with probability 3e-6.

Edge cases: a text without words (null, empty, only punctuation) is similar to nothing. A text of
fewer than five words is one shingle of all its words. Texts with the same words in the same order
are one text here. Every row counts by its own text, also where doc_ids repeat; a missing doc_id is
greater than any other. Rows that repeat a doc_id and a text are each marked as kept or each as
not, and `keep_one` keeps one of them.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.grouping import classes
from tallyhouse.llm.shared import checked, cut, row_groups
from tallyhouse.llm.words import mix, sequence_hash, shingles, words

BANDS, ROWS, SIMILARITY = 24, 4, 0.8
#: Rows from which on a bucket is crowded; rows of one that are compared at once with as many.
BIG, CHUNK = 32, 512
_COLUMNS = 4096
_OCTAVE = np.uint64(0xC2B2AE3D27D4EB4F)
_ARRIVAL = np.uint64(0x165667B19E3779F9)


def multiset(text: str | None, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The text's different shingles in order of their hash, and how often each occurs."""
    return np.unique(shingles(words(text), size), return_counts=True)


def weighted_jaccard(
    a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]
) -> float:
    _, left, right = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][left], b[1][right]).sum())
    total = int(a[1].sum() + b[1].sum()) - common
    return common / total if total else 0.0


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], slots: int) -> np.ndarray:
    """The BagMinHash signature of each non-empty bag: the seed of each slot's earliest point."""
    ids, counts, owner = [], [], []
    for row, (values, weights) in enumerate(bags):
        ids.append(values)
        counts.append(weights)
        owner.append(np.full(len(values), row))
    seed, weight, doc = (np.concatenate(x) for x in (ids, counts, owner))
    total = np.bincount(doc, weights=weight, minlength=len(bags))
    low, parts = 0, []
    inside = np.arange(len(seed))
    while len(inside):
        width = max(low, 1)
        parts.append((inside, np.full(len(inside), low), np.full(len(inside), width)))
        low = low + width
        inside = inside[weight[inside] > low]
    at, low, width = (np.concatenate(x) for x in zip(*parts, strict=True))
    doc, weight = doc[at], weight[at]
    seed = mix(seed[at] ^ ((low.astype(np.uint64) + np.uint64(1)) * _OCTAVE))
    time = _waiting(seed, width)
    best = np.full(len(bags) * slots, np.inf)
    point = np.zeros(len(bags) * slots, dtype=np.uint64)
    until = slots * (np.log(slots) + 3.0) / total
    open_docs = np.ones(len(bags), dtype=bool)
    while True:
        active = np.flatnonzero(open_docs[doc] & (time < until[doc]))
        while len(active):
            here = seed[active]
            place = low[active] + _uniform(mix(here ^ _ARRIVAL)) * width[active]
            slot = (mix(here + _OCTAVE) % np.uint64(slots)).astype(np.int64)
            own = place < weight[active]
            cell, when, what = (doc[active] * slots + slot)[own], time[active][own], here[own]
            earlier = when < best[cell]
            cell, when, what = cell[earlier], when[earlier], what[earlier]
            np.minimum.at(best, cell, when)
            first = best[cell] == when
            point[cell[first]] = what[first]
            seed[active] = mix(here + _ARRIVAL)
            time[active] += _waiting(seed[active], width[active])
            active = active[time[active] < until[doc[active]]]
        open_docs = np.isinf(best.reshape(len(bags), slots)).any(axis=1)
        if not open_docs.any():
            return point.reshape(len(bags), slots)
        until = np.where(open_docs, until * 2, until)


def _uniform(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(11)).astype(np.float64) * 2.0**-53


def _waiting(seed: np.ndarray, rate: np.ndarray) -> np.ndarray:
    return -np.log1p(-_uniform(mix(seed * np.uint64(0x9FB21C651E98DF25)))) / rate


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A key for each band of each signature; keys of different bands differ."""
    out = np.zeros((len(signature), bands), dtype=np.uint64) + np.arange(bands, dtype=np.uint64)
    parts = signature.reshape(len(signature), bands, rows)
    for row in range(rows):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, row])
    return out.view(np.int64)


def row_key() -> Column:
    """Tells apart rows that differ in doc_id or text."""
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.concat_ws(":", doc_id, F.xxhash64("text").cast("string"))


def signed(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, the key of its row, one of its sequence of words, and its band keys (null without
    words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_groups(batches, "text"):
            hashes = [words(text) for text in batch.column("text").to_pylist()]
            full = [row for row, found in enumerate(hashes) if len(found)]
            bags = [np.unique(shingles(hashes[row]), return_counts=True) for row in full]
            keys: list = [None] * len(hashes)
            if bags:
                made = band_keys(signatures(bags, bands * rows), bands, rows)
                for row, key in zip(full, made, strict=True):
                    keys[row] = key
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("row_key"),
                    pa.array([sequence_hash(h) if len(h) else None for h in hashes], pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["doc_id", "row_key", "words_key", "bands"],
            )

    return docs.select("doc_id", row_key().alias("row_key"), "text").mapInArrow(
        run, "doc_id long, row_key string, words_key binary, bands array<long>"
    )


def similar_pairs(pairs: DataFrame, bodies: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose texts in bodies (id, text) are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: OrderedDict[int, tuple] = OrderedDict()

        def bag(key: int, text: str) -> tuple[np.ndarray, np.ndarray]:
            if key not in recent:
                recent[key] = multiset(text)
                if len(recent) > 64:
                    recent.popitem(last=False)
            return recent[key]

        for batch in row_groups(batches, "b_text"):
            columns = [batch.column(n).to_pylist() for n in ("a", "b", "a_text", "b_text")]
            kept = [
                (a, b)
                for a, b, a_text, b_text in zip(*columns, strict=True)
                if weighted_jaccard(bag(a, a_text), bag(b, b_text)) >= similarity
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[i] for p in kept], pa.int64()) for i in (0, 1)], names=["a", "b"]
            )

    first = bodies.select(F.col("id").alias("a"), F.col("text").alias("a_text"))
    second = bodies.select(F.col("id").alias("b"), F.col("text").alias("b_text"))
    both = pairs.join(first, "a").join(second, "b")
    return both.select("a", "b", "a_text", "b_text").mapInArrow(run, "a long, b long")


def similarities(
    left: list[tuple[np.ndarray, np.ndarray]], right: list[tuple[np.ndarray, np.ndarray]]
) -> np.ndarray:
    """The weighted Jaccard similarity of every left multiset with every right one.

    The k-th occurrence of a shingle is an element of its own, which makes sets of the multisets;
    their overlaps are one product of matrices, a few thousand elements at a time."""
    items = [_occurrences(bag) for bag in [*left, *right]]
    owner = np.repeat(np.arange(len(items)), [len(x) for x in items])
    _, number, count = np.unique(
        np.concatenate(items), return_inverse=True, return_counts=True
    )
    shared = count[number] > 1
    owner, number = owner[shared], np.unique(number[shared], return_inverse=True)[1]
    order = np.argsort(number, kind="stable")
    owner, number = owner[order], number[order]
    overlap = np.zeros((len(left), len(right)), dtype=np.float64)
    for first in range(0, int(number[-1]) + 1 if len(number) else 0, _COLUMNS):
        low, high = np.searchsorted(number, [first, first + _COLUMNS])
        cells = np.zeros((len(items), _COLUMNS), dtype=np.float32)
        cells[owner[low:high], number[low:high] - first] = 1
        overlap += cells[: len(left)] @ cells[len(left) :].T
    sizes = np.array([len(x) for x in items], dtype=np.float64)
    total = sizes[: len(left), None] + sizes[None, len(left) :] - overlap
    return np.where(total > 0, overlap / np.maximum(total, 1), 0.0)


def _occurrences(bag: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    values, counts = bag
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return mix(np.repeat(values, counts) + nth.astype(np.uint64) * _OCTAVE)


def block_links(members: DataFrame, bodies: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) that connect what is similar across classes within the buckets of members
    (key, id, class_id, n).

    A bucket is dealt into chunks, and each pair of chunks is compared at once, in a task of its
    own; only links that connect something go out, never a row for each pair."""
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    own = F.pmod(F.xxhash64("id"), chunks).cast("int")
    others = F.explode(F.sequence(F.lit(0), chunks - 1)).alias("with")
    dealt = members.select("key", "id", "class_id", own.alias("own"), others).select(
        "key", "id", "class_id", "own",
        F.least("own", "with").alias("low"), F.greatest("own", "with").alias("high"),
    )

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        _, low, high = key
        sides = [rows[rows["own"] == chunk] for chunk in (low, high)]
        bags = [[multiset(text) for text in side["text"]] for side in sides]
        ids, group = [x["id"].to_numpy() for x in sides], [x["class_id"].to_numpy() for x in sides]
        if not len(ids[0]) or not len(ids[1]):
            return pd.DataFrame({"a": [], "b": []})
        alike = similarities(*bags) >= similarity
        alike &= group[0][:, None] != group[1][None, :]
        parent: dict[int, int] = {}

        def top(x: int) -> int:
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        found = []
        for i, j in np.argwhere(alike).tolist():
            a, b = top(int(group[0][i])), top(int(group[1][j]))
            if a != b:
                parent[max(a, b)] = min(a, b)
                found.append(sorted((int(ids[0][i]), int(ids[1][j]))))
        return pd.DataFrame(found, columns=["a", "b"])

    return (
        dealt.join(bodies, "id")
        .groupBy("key", "low", "high")
        .applyInPandas(compare, "a long, b long")
    )


def near_classes(
    docs: DataFrame,
    bands: int = BANDS,
    rows: int = ROWS,
    similarity: float = SIMILARITY,
    big: int = BIG,
) -> DataFrame:
    """A row per document: doc_id, class_id (the smallest doc_id of its group), kept.

    Buckets of more than `big` rows are compared in blocks; the result is the same."""
    placed = _placed(docs, bands, rows, similarity, big)
    return placed.select("doc_id", "class_id", "kept")


def _placed(
    docs: DataFrame,
    bands: int = BANDS,
    rows: int = ROWS,
    similarity: float = SIMILARITY,
    big: int = BIG,
) -> DataFrame:
    """doc_id, row_key, class_id and kept of every row."""
    signs = cut(signed(docs, bands, rows))
    first = F.struct(F.col("doc_id").isNull().alias("unnumbered"), "doc_id", "row_key")
    # A number for each different text, fixed by being written.
    texts = cut(
        signs.where("words_key is not null")
        .groupBy("words_key")
        .agg(F.min(F.struct(first.alias("row"), "bands")).alias("one"), F.count("*").alias("n"))
        .select(
            F.monotonically_increasing_id().alias("id"), "words_key", "n", "one.row", "one.bands"
        )
    )
    buckets = texts.select("id", F.explode("bands").alias("key"))
    keys = texts.select("id", F.col("row.row_key").alias("row_key"))

    def bodies(ids: DataFrame) -> DataFrame:
        wanted = checked(cut(keys.join(ids, "id", "left_semi")))
        found = docs.select(row_key().alias("row_key"), "text").join(wanted, "row_key")
        return cut(found.groupBy("id").agg(F.max("text").alias("text")))

    def verify(pairs: DataFrame) -> DataFrame:
        ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        return similar_pairs(pairs, bodies(ids), similarity)

    def verify_blocks(members: DataFrame) -> DataFrame:
        return block_links(members, bodies(members.select("id").distinct()), similarity)

    label = classes(buckets, verify, verify_blocks, big)
    linked = cut(texts.join(label, "id", "left").withColumn("no", F.coalesce("class_id", "id")))
    least = linked.where("class_id is not null").groupBy("no").agg(F.min("row").alias("least"))
    moved = cut(
        linked.join(least, "no", "left")
        .withColumn("first", F.coalesce("least", "row"))
        .where("n > 1 or first != row")
        .select("words_key", "first")
    )
    placed = signs.select("doc_id", "row_key", "words_key").join(moved, "words_key", "left")
    told = F.col("first").isNotNull()
    class_id = F.when(told, F.col("first.doc_id")).otherwise(F.col("doc_id"))
    kept = ~told | (F.col("first.row_key") == F.col("row_key"))
    return placed.select("doc_id", "row_key", class_id.alias("class_id"), kept.alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents with one row of each group of near duplicates, with all their columns.

    Rows move once, dealt by their key; of equal rows a task sends one."""
    key = "__row_key"
    dropped = _placed(docs).where("not kept").select(F.col("row_key").alias(key)).distinct()
    alike = Window.partitionBy(key).orderBy(key)
    rows = docs.withColumn(key, row_key())
    rows = rows.withColumn("__rank", F.row_number().over(alike)).where("__rank = 1")
    return rows.join(dropped, key, "left_anti").select(*docs.columns)
