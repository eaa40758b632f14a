"""Ranked lexical search by groups of documents that hold the same terms of an item.

A term is a run of ASCII letters and digits and characters beyond ASCII; A-Z are lower-cased. The
items' terms go to the executors in blocks of a bounded number; of each document only its number of
terms and how often it holds terms of the block are kept. Document frequencies, the number of
documents and of all terms follow from these by aggregation over all documents.

Documents are ranked in segments, each by one task: for an item a segment has a bitmap over its
documents for each of the item's terms. Stacked, these give every document its presence mask, the
set of the item's terms that it holds. Documents are grouped by mask. The most that a mask can
score is the sum over its terms of the greatest share that the term has in any document of the
segment. Masks are scored in the order of that maximum, highest first, until `top` documents score
above the maximum of all masks that are left: none of these could come in, not even by a tie.
Segments hand on their `top` documents of each item; two rounds of ranking leave the best of all.

Terms are told apart by 64 bits of hash. A score is a sum of integers, so it does not depend on
the order of rows or tasks.

Edge cases: null and empty texts hold no terms and are not counted as documents; an item without
terms finds none. Rows of the benchmark that repeat an item_id are items of their own. Of equal
scores the smaller doc_id ranks first, a null doc_id last; repeated rows rank one after the other.
Documents that share no term with an item, or only terms that weigh nothing, are not ranked. Empty
tables give an empty result. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.shared import row_groups, stored
from tallyhouse.llm.words import range_hashes

#: Documents of a result, and terms of items that go to the executors at a time.
TOP, BLOCK_TERMS = 50, 200_000
#: Documents to a segment, and parts of a ranking's first round.
SEGMENT, PARTS = 32_768, 64

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_TERM_BYTE = np.zeros(256, dtype=bool)
_TERM_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True

_POSTING_DDL = "doc_id long, n long, terms array<int>, counts array<int>"
_FOUND = pa.schema(
    [("item", pa.int64()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())]
)


def term_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every term of the texts, in order, and the number of its text."""
    data = np.frombuffer(b"\n".join(texts).translate(_LOWER), dtype=np.uint8)
    inside = np.concatenate(([False], _TERM_BYTE[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    begins = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
    owner = np.searchsorted(begins, starts, "right") - 1
    return range_hashes(data, starts, ends), owner


def _bytes(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


@dataclass
class Block:
    """Items of a benchmark: their ids, the places of their terms in `terms` (hashes, in order)."""

    ids: list
    items: list[np.ndarray]
    terms: np.ndarray


def blocks(benchmark: DataFrame, block_terms: int = BLOCK_TERMS) -> Iterator[Block]:
    """The items in blocks of about `block_terms` terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_groups(batches, "text"):
            hashes, owner = term_hashes(_bytes(batch))
            bounds = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            found = [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("item_id"),
                    pa.array([len(f) for f in found], pa.int64()),
                    pa.array([f.tobytes() for f in found], pa.binary()),
                ],
                names=["item_id", "n_terms", "terms"],
            )

    items = (
        benchmark.select(F.col("item_id").cast("long"), "text")
        .mapInArrow(run, "item_id long, n_terms long, terms binary")
        .where("n_terms > 0")
    )
    total = items.agg(F.sum("n_terms")).first()[0] or 0
    count = -(-total // block_terms)
    for block in range(count):
        here = F.pmod(F.xxhash64("item_id", "terms"), F.lit(count)) == block
        rows = items.where(here).collect()
        own = [np.frombuffer(row["terms"], dtype=np.uint64) for row in rows]
        if own:
            terms = np.unique(np.concatenate(own))
            places = [np.searchsorted(terms, o) for o in own]
            yield Block([r["item_id"] for r in rows], places, terms)


def postings(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """doc_id, n (terms of the document, with repeats), and which of the given terms it holds how
    often, for every document with a term."""
    sent = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = sent.value
        for batch in row_groups(batches, "text"):
            hashes, owner = term_hashes(_bytes(batch))
            place = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
            hit = terms[place] == hashes
            both, count = np.unique(owner[hit] * len(terms) + place[hit], return_counts=True)
            ends = np.searchsorted(both // len(terms), np.arange(batch.num_rows + 1))
            offsets = pa.array(ends.astype(np.int32))
            held = pa.array((both % len(terms)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.bincount(owner, minlength=batch.num_rows).astype(np.int64)),
                    pa.ListArray.from_arrays(offsets, held),
                    pa.ListArray.from_arrays(offsets, pa.array(count.astype(np.int32))),
                ],
                names=["doc_id", "n", "terms", "counts"],
            )

    texts = docs.select(F.col("doc_id").cast("long"), "text")
    return texts.mapInArrow(run, _POSTING_DDL).where("n > 0")


@dataclass
class Corpus:
    """What scores depend on besides a document: how many documents and terms there are in all,
    and the weight of each term of the block."""

    documents: int
    terms: int
    weights: np.ndarray

    @classmethod
    def of(cls, held: DataFrame, n_terms: int) -> Corpus:
        """Counted over all documents; there is a row per term of the block."""
        documents, terms = held.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        weights = np.zeros(n_terms, dtype=np.int64)
        held_by = held.select(F.explode("terms").alias("term")).groupBy("term").count()
        for term, found in held_by.collect():
            weights[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * found + 1)))
        return cls(documents, terms, weights)

    def lengths(self, n: np.ndarray) -> np.ndarray:
        """How long documents are for the score, 100 for a mean one."""
        return 100 - 50 + (50 * n * self.documents) // self.terms


class Segment:
    """Documents, and for each term the ones that hold it, with the term's share of their scores."""

    def __init__(
        self, ids: np.ndarray, n: np.ndarray, owner: np.ndarray, term: np.ndarray,
        count: np.ndarray, corpus: Corpus,
    ):
        self.ids = ids
        count = count.astype(np.int64)
        part = (1_000_000_000 * count) // (1000 * count + 20 * corpus.lengths(n)[owner])
        order = np.argsort(term, kind="stable")
        self.owner, self.share = owner[order], (corpus.weights[term] * part)[order]
        self.bounds = np.searchsorted(term[order], np.arange(len(corpus.weights) + 1))

    def masks(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The different presence masks (rows of bits, the empty mask left out), and each
        document's number among them, -1 for documents that hold none of the terms."""
        bitmaps = np.zeros((len(terms), len(self.ids)), dtype=bool)
        for row, term in enumerate(terms):
            bitmaps[row, self.owner[self.bounds[term] : self.bounds[term + 1]]] = True
        held = np.flatnonzero(bitmaps.any(axis=0))
        packed = np.packbits(bitmaps[:, held], axis=0).T
        words = np.zeros((len(held), -(-packed.shape[1] // 8) * 8), dtype=np.uint8)
        words[:, : packed.shape[1]] = packed
        kind = np.dtype(np.uint64) if words.shape[1] == 8 else np.dtype((np.void, words.shape[1]))
        _, first, number = np.unique(
            words.view(kind).ravel(), return_index=True, return_inverse=True
        )
        return bitmaps[:, held[first]].T, held, number.ravel()

    def best(self, terms: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and scores of the `top` documents for an item, at least: all that could be."""
        spans = [(self.bounds[t], self.bounds[t + 1]) for t in terms]
        most = np.array([self.share[a:b].max(initial=0) for a, b in spans], dtype=np.int64)
        terms, spans = terms[most > 0], [s for s, m in zip(spans, most, strict=True) if m > 0]
        most = most[most > 0]
        if not len(terms):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        bits, held, number = self.masks(terms)
        limit = bits.astype(np.int64) @ most
        turn = np.argsort(-limit, kind="stable")
        sizes = np.bincount(number, minlength=len(limit))
        by_mask = np.argsort(number, kind="stable")
        starts = np.cumsum(sizes) - sizes
        # The shares of one document at a time would be slow: masks are scored some at a time,
        # each time about as many documents as before in all.
        scores = np.zeros(len(self.ids), dtype=np.int64)
        scored: list[np.ndarray] = []
        done, kth, step = 0, -1, top
        after = np.cumsum(sizes[turn])
        while done < len(turn) and limit[turn[done]] >= kth:
            upto = int(np.searchsorted(after, step, "left")) + 1
            upto = min(max(upto, done + 1), len(turn))
            some = turn[done:upto]
            places = np.concatenate([by_mask[starts[m] : starts[m] + sizes[m]] for m in some])
            documents = held[places]
            wanted = np.zeros(len(self.ids), dtype=bool)
            wanted[documents] = True
            holds = bits[some].any(axis=0)
            for (a, b), there in zip(spans, holds, strict=True):
                if there:
                    owner = self.owner[a:b]
                    here = wanted[owner]
                    scores[owner[here]] += self.share[a:b][here]
            scored.append(documents)
            done, step = upto, 2 * int(after[upto - 1])
            known = scores[np.concatenate(scored)]
            if len(known) >= top:
                kth = int(np.partition(known, len(known) - top)[len(known) - top])
        documents = np.concatenate(scored)
        return documents, scores[documents]


def _segments(
    batches: Iterator[pa.RecordBatch], corpus: Corpus, size: int
) -> Iterator[Segment]:
    def made(some: list[pa.RecordBatch]) -> Segment:
        table = pa.Table.from_batches(some)
        terms, counts = table.column("terms"), table.column("counts")
        sizes = np.concatenate([np.diff(c.offsets.to_numpy()) for c in terms.chunks])
        ids = table.column("doc_id")
        nulls = ids.is_null().to_numpy()
        ids = np.ma.masked_array(ids.fill_null(0).to_numpy(), mask=nulls)
        flat = [np.concatenate([c.flatten().to_numpy() for c in x.chunks]) for x in (terms, counts)]
        owner = np.repeat(np.arange(len(sizes)), sizes)
        return Segment(ids, table.column("n").to_numpy(), owner, flat[0], flat[1], corpus)

    some: list[pa.RecordBatch] = []
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            some.append(batch.slice(start, size))
            if sum(b.num_rows for b in some) >= size:
                yield made(some)
                some = []
    if some:
        yield made(some)


def candidates(
    held: DataFrame, block: Block, corpus: Corpus, top: int = TOP, segment: int = SEGMENT
) -> DataFrame:
    """(item, item_id, doc_id, score): the `top` documents of each segment for each item."""
    sent = held.sparkSession.sparkContext.broadcast((block, corpus))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, corpus = sent.value
        for part in _segments(batches, corpus, segment):
            for item, (item_id, terms) in enumerate(zip(block.ids, block.items, strict=True)):
                documents, scores = part.best(terms, top)
                good = scores > 0
                documents, scores = documents[good], scores[good]
                ids = part.ids[documents]
                order = np.lexsort((ids.filled(0), ids.mask, -scores))[:top]
                ids = ids[order]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([item] * len(order), pa.int64()),
                        pa.array([item_id] * len(order), pa.int64()),
                        pa.array(ids.filled(0), pa.int64(), mask=np.ma.getmaskarray(ids)),
                        pa.array(scores[order], pa.int64()),
                    ],
                    schema=_FOUND,
                )

    return held.mapInArrow(run, "item long, item_id long, doc_id long, score long")


def ranked(found: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score of the `top` documents of each item.

    The first round ranks an item's documents in parts, so that the second has few of each."""
    best = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    dealt = found.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)))
    for keys in (["item", "item_id", "part"], ["item", "item_id"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*best))
        dealt = dealt.withColumn("rank", place).where(F.col("rank") <= top)
    return dealt.select("item_id", "rank", "doc_id", "score")


def search(
    docs: DataFrame,
    benchmark: DataFrame,
    top: int = TOP,
    block_terms: int = BLOCK_TERMS,
    segment: int = SEGMENT,
) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the best documents of all for each item."""
    out = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in blocks(benchmark, block_terms):
        held = stored(postings(docs, block.terms))
        corpus = Corpus.of(held, len(block.terms))
        out = out.union(ranked(candidates(held, block, corpus, top, segment), top))
    return out
