"""Benchmark decontamination by greedy string tiling.

Texts are sequences of words. A tile is a run of at least five words that a document and a
benchmark item share; tiles overlap in neither. The longest match is marked first, then the
longest of what is left, and so on, so an item whose passages were put in another order is still
covered. An item is leaked by a document when its tiles cover half of its words.

Seeds are Karp-Rabin hashes of five words, rolled over both sides. The benchmark goes to the
executors in blocks of a bounded number of words, and each block is matched against all documents;
no document is shuffled. Of each document only the items whose seeds could reach the threshold
are tiled: a tile consists of seeds, so this loses nothing.

Edge cases: null and empty texts match nothing; items of fewer than five words are not searched
for, as such runs occur by chance. Items with equal texts are reported each. Repeated rows give
repeated results, and `drop_leaked` decides on each row by its own text.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.shared import filtered, row_groups
from tallyhouse.llm.words import words

#: Words of the shortest tile; share of an item's words that tiles must cover.
TILE, COVERAGE = 5, 0.5
#: Words of the benchmark that go to the executors at a time (eight bytes each).
BLOCK_WORDS = 1_000_000
#: Pairs of equal seeds of a document and an item that are listed.
MOST_PAIRS = 2_000_000
_RADIX = np.uint64(0x9E3779B97F4A7C15)


def rolling(hashes: np.ndarray, size: int) -> np.ndarray:
    """The Karp-Rabin hash of each run of `size` words."""
    count = len(hashes) - size + 1
    if count < 1:
        return hashes[:0]
    out = np.zeros(count, dtype=np.uint64)
    for offset in range(size):
        out = out * _RADIX + hashes[offset : offset + count]
    return out


def tiles(
    doc: np.ndarray, item: np.ndarray, least: int, doc_seeds: np.ndarray, item_seeds: np.ndarray
) -> list[tuple[int, int, int]]:
    """Greedy tiling: (place in the item, place in the document, number of words) of each tile.

    Of equally long matches the one earlier in the item, then in the document, goes first. Where
    seeds repeat so much that a list of all pairs would not fit, as in a page of one word over and
    over, the longest match is looked for anew for each tile."""
    order = np.argsort(item_seeds, kind="stable")
    low = np.searchsorted(item_seeds[order], doc_seeds, "left")
    count = np.searchsorted(item_seeds[order], doc_seeds, "right") - low
    if count.sum() > MOST_PAIRS:
        return _tiles_one_by_one(doc, item, least)
    at = np.repeat(np.arange(len(doc_seeds)), count)
    nth = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
    in_item = order[np.repeat(low, count) + nth]
    by = np.lexsort((in_item, at - in_item))
    in_item, at = in_item[by], at[by]
    fresh = np.ones(len(at), dtype=bool)
    fresh[1:] = (np.diff(at) != 1) | (np.diff(in_item) != 1)
    first = np.flatnonzero(fresh)
    length = np.diff(np.append(first, len(at))) + least - 1
    heap = [
        (-int(n), int(i), int(d)) for n, i, d in zip(length, in_item[first], at[first], strict=True)
    ]
    heapq.heapify(heap)
    doc_free, item_free = np.ones(len(doc), dtype=bool), np.ones(len(item), dtype=bool)
    out = []
    while heap:
        size, i, d = heapq.heappop(heap)
        size = -size
        free = item_free[i : i + size] & doc_free[d : d + size]
        free &= item[i : i + size] == doc[d : d + size]
        if free.all():
            item_free[i : i + size] = doc_free[d : d + size] = False
            out.append((i, d, size))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate(([0], free.view(np.int8), [0]))))
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if end - start >= least:
                heapq.heappush(heap, (start - end, i + start, d + start))
    return sorted(out)


def _tiles_one_by_one(
    doc: np.ndarray, item: np.ndarray, least: int
) -> list[tuple[int, int, int]]:
    """The same tiles with memory in proportion to the texts. Words that the other side lacks end
    every match, so only the others are compared."""
    doc_free, item_free = np.isin(doc, item), np.isin(item, doc)
    out = []
    while True:
        best = (0, 0, 0)
        length = np.zeros(len(doc) + 1, dtype=np.int32)
        for i in range(len(item) - 1, -1, -1):
            if not item_free[i]:
                length[:] = 0
                continue
            # The match that starts here is one word longer than the one after it on both sides.
            length[:-1] = np.where((doc == item[i]) & doc_free, length[1:] + 1, 0)
            longest = int(length.max())
            if longest >= max(best[2], least):
                best = (i, int(length.argmax()), longest)
        i, d, size = best
        if not size:
            return sorted(out)
        item_free[i : i + size] = doc_free[d : d + size] = False
        out.append(best)


@dataclass
class Block:
    """Items of a benchmark, and their seeds in order."""

    ids: list
    items: list[np.ndarray]
    least: int

    def __post_init__(self) -> None:
        seeds = [rolling(item, self.least) for item in self.items]
        owner = np.repeat(np.arange(len(seeds)), [len(s) for s in seeds])
        place = np.concatenate([np.arange(len(s)) for s in seeds] or [np.zeros(0, int)])
        values = np.concatenate(seeds or [np.zeros(0, np.uint64)])
        order = np.argsort(values, kind="stable")
        self.owner, self.place = owner[order], place[order]
        self.values, self.first = np.unique(values[order], return_index=True)
        self.count = np.diff(np.append(self.first, len(values)))

    def candidates(self, seeds: np.ndarray, coverage: float) -> tuple[np.ndarray, list[int]]:
        """Which of the document's seeds occur in the block; the items they can cover enough of."""
        if not len(seeds) or not len(self.values):
            return np.zeros(len(seeds), dtype=bool), []
        at = np.minimum(np.searchsorted(self.values, seeds), len(self.values) - 1)
        hit = self.values[at] == seeds
        if not hit.any():
            return hit, []
        known = np.unique(at[hit])
        count = self.count[known]
        nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        rows = np.repeat(self.first[known], count) + nth
        found = []
        owners, places = self.owner[rows], self.place[rows]
        by = np.argsort(owners, kind="stable")
        owners, places = owners[by], places[by]
        edges = np.flatnonzero(np.diff(owners)) + 1
        for some in np.split(np.arange(len(owners)), edges):
            item = int(owners[some[0]])
            covered = np.zeros(len(self.items[item]), dtype=bool)
            for offset in range(self.least):
                covered[places[some] + offset] = True
            if covered.sum() >= coverage * len(covered):
                found.append(item)
        return hit, found


    def leaked(
        self, text: str | None, coverage: float
    ) -> Iterator[tuple[int, list[tuple[int, int, int]], int]]:
        """The items that a text leaks: their numbers, tiles, and how many words these cover."""
        doc = words(text)
        seeds = rolling(doc, self.least)
        _, found = self.candidates(seeds, coverage)
        for number in found:
            item = self.items[number]
            marked = tiles(doc, item, self.least, seeds, rolling(item, self.least))
            covered = sum(t[2] for t in marked)
            if covered >= coverage * len(item):
                yield number, marked, covered


def blocks(benchmark: DataFrame, least: int, block_words: int) -> Iterator[Block]:
    """The benchmark in blocks of about `block_words` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_groups(batches, "text"):
            found = [words(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("item_id"),
                    pa.array([len(w) for w in found], pa.int64()),
                    pa.array([w.tobytes() for w in found], pa.binary()),
                ],
                names=["item_id", "n_words", "words"],
            )

    items = (
        benchmark.select("item_id", "text")
        .mapInArrow(run, "item_id long, n_words long, words binary")
        .where(F.col("n_words") >= least)
    )
    total = items.agg(F.sum("n_words")).first()[0] or 0
    count = -(-total // block_words)
    for block in range(count):
        here = F.pmod(F.xxhash64("item_id", "words"), F.lit(count)) == block
        rows = items.where(here).select("item_id", "words").collect()
        yield Block(
            [row["item_id"] for row in rows],
            [np.frombuffer(row["words"], dtype=np.uint64) for row in rows],
            least,
        )


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    least: int = TILE,
    coverage: float = COVERAGE,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """doc_id, item_id, n_words of the item, how many are covered, coverage, and the tiles
    (item_start, doc_start, n_words), for each item that a document leaks."""
    schema = (
        "doc_id long, item_id long, n_words long, n_covered long, coverage double, "
        "tiles array<struct<item_start:int,doc_start:int,n_words:int>>"
    )
    tile = pa.struct([(n, pa.int32()) for n in ("item_start", "doc_start", "n_words")])
    kinds = [pa.int64()] * 4 + [pa.float64(), pa.list_(tile)]
    names = ["doc_id", "item_id", "n_words", "n_covered", "coverage", "tiles"]
    context = docs.sparkSession.sparkContext
    out = docs.sparkSession.createDataFrame([], schema)
    for block in blocks(benchmark, least, block_words):
        sent = context.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            block = sent.value
            for batch in row_groups(batches, "text"):
                rows: list[tuple] = []
                for doc_id, text in zip(
                    batch.column("doc_id").to_pylist(),
                    batch.column("text").to_pylist(),
                    strict=True,
                ):
                    for number, marked, covered in block.leaked(text, coverage):
                        size = len(block.items[number])
                        spans = [
                            {"item_start": i, "doc_start": d, "n_words": n} for i, d, n in marked
                        ]
                        rows.append(
                            (doc_id, block.ids[number], size, covered, covered / size, spans)
                        )
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)],
                    names=names,
                )

        out = out.union(docs.select("doc_id", "text").mapInArrow(run, schema))
    return out


def drop_leaked(
    docs: DataFrame,
    benchmark: DataFrame,
    least: int = TILE,
    coverage: float = COVERAGE,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The documents that leak no item, with all their columns. Each row is judged by its own text,
    whatever its doc_id."""
    context = docs.sparkSession.sparkContext
    for block in blocks(benchmark, least, block_words):
        sent = context.broadcast(block)

        def clean(texts: list[str | None], sent=sent) -> list[bool]:
            return [not any(sent.value.leaked(text, coverage)) for text in texts]

        docs = filtered(docs, clean)
    return docs
