"""Passages that repeat across documents, found by windows of doubling length.

A window is a number of consecutive words of one document. A word goes when a window over it also
starts in a document with a smaller doc_id. Looking for whole windows at once would move a key for
every word of the corpus, so shorter windows are tried first: a whole window can only repeat if the
least of the short ones inside it (by its hash) occurs in two documents. Neighbouring whole windows
mostly share that least one, so a fourth of the words are asked about; only whole windows that are
left are asked about at twice that length, and so on up to the whole window, or until none is left.

Documents are dealt to chunks of a bounded size in a table bucketed by chunk, written once and read
at each level without a shuffle. A chunk asks about each different key once, so a passage in a third
of all documents is a row per chunk. Keys go by their high bits to bins; a bin answers each chunk
with a bit per key. The last level asks with 96 bits of hash besides the bin, and its bit says
whether a smaller document has the window; the levels before only spare work, and compare 32 bits.

Edge cases: null and empty texts have no words. A document of fewer words than a window keeps them
all. Rows that repeat a doc_id do not take words from each other. Rows without a doc_id are compared
with none. An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.shared import checkpoint_folder, cut
from tallyhouse.llm.words import mix, range_hashes

#: Words of a window, and of the shortest windows that are tried.
WINDOW, SHORTEST = 13, 7
#: Bytes of text to a chunk (a longer document is one alone), and chunks to a bucket of the table.
CHUNK_BYTES, CHUNKS_A_BUCKET = 8_000_000, 2
#: Bytes of text for each bin of keys, and the most buckets and bins.
BIN_BYTES, MOST_PARTS = 16_000_000, 50_000

_PLAIN = np.ones(256, dtype=bool)
_PLAIN[[*range(9, 14), 32]] = False
_RADIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_ASKED = np.dtype([("high", "<u8"), ("low", "<u4"), ("first", "<i8")])

_ASK = pa.schema([("chunk", pa.int64()), ("bin", pa.int64()), ("keys", pa.binary())])
_ANSWER = pa.schema(
    [("chunk", pa.int64()), ("level", pa.int32()), ("bin", pa.int64()), ("bits", pa.binary())]
)
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("removed", pa.list_(_SPAN)),
        ("kept_text", pa.string()),
    ]
)
_RESULT_DDL = (
    "doc_id long, n_words long, n_removed long, removed array<struct<start:long,end:long>>, "
    "kept_text string"
)


def lengths(window: int = WINDOW, shortest: int = SHORTEST) -> list[int]:
    """The lengths of the levels: doubled from `shortest` on, and the window itself."""
    out = [min(shortest, window)]
    while out[-1] < window:
        out.append(min(2 * out[-1], window))
    return out


@dataclass
class Chunk:
    """The words of a chunk's documents, in the order of doc_id, and the windows still asked about.

    `alive` holds the places (of the chunk's words) where such windows start."""

    ids: list
    texts: list[bytes]
    hashes: np.ndarray
    document: np.ndarray
    numbers: np.ndarray
    window: int
    alive: np.ndarray

    @classmethod
    def of(cls, table: pa.Table, window: int) -> Chunk:
        table = table.sort_by([("doc_id", "ascending")])
        ids = table.column("doc_id").to_pylist()
        texts = [t or b"" for t in table.column("text").cast(pa.binary()).to_pylist()]
        data = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
        inside = np.concatenate(([False], _PLAIN[data], [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        begins = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
        document = np.searchsorted(begins, starts, "right") - 1
        numbers = np.array([0 if i is None else i for i in ids], dtype=np.int64)
        numbered = np.array([i is not None for i in ids], dtype=bool)
        places = np.arange(max(0, len(starts) - window + 1))
        whole = document[places] == document[places + window - 1]
        whole &= numbered[document[places]]
        hashes = range_hashes(data, starts, ends)
        return cls(ids, texts, hashes, document, numbers, window, places[whole])

    def owners(self) -> np.ndarray:
        """The doc_id of each window's document."""
        return self.numbers[self.document[self.alive]]

    def rolled(self, length: int, radix: np.uint64) -> np.ndarray:
        """A hash for each run of `length` words."""
        count = len(self.hashes) - length + 1
        out = np.zeros(max(0, count), dtype=np.uint64)
        for offset in range(length if count > 0 else 0):
            out = out * radix + self.hashes[offset : offset + count]
        return mix(out)

    def keys(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Two parts of each window's key: of the least run of `length` words in it."""
        rolled = self.rolled(length, _RADIX[0])
        if length == self.window:
            second = self.rolled(length, _RADIX[1])[self.alive] if len(rolled) else rolled
            return rolled[self.alive] if len(rolled) else rolled, second.astype(np.uint32)
        if not len(self.alive):
            return rolled[:0], np.zeros(0, np.uint32)
        least = rolled[: len(self.hashes) - self.window + 1].copy()
        for offset in range(1, self.window - length + 1):
            np.minimum(least, rolled[offset : offset + len(least)], out=least)
        return least[self.alive], np.zeros(len(self.alive), np.uint32)

    def asked(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each different key with the smallest doc_id that has it, in order; whether another
        document of this chunk has it; and the number of each window's key."""
        high, low = self.keys(length)
        owners = self.owners()
        # Neighbouring windows of a document mostly share their key: they are told once.
        fresh = np.ones(len(high), dtype=bool)
        fresh[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1]) | (owners[1:] != owners[:-1])
        turn = np.cumsum(fresh) - 1
        high, low, owners = high[fresh], low[fresh], owners[fresh]
        # A stable order: the smallest document of a key comes first, the greatest last.
        order = (
            np.lexsort((low, high)) if length == self.window else np.argsort(high, kind="stable")
        )
        high, low, owners = high[order], low[order], owners[order]
        new = np.ones(len(high), dtype=bool)
        new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(high)) - 1
        out = np.empty(len(first) if len(high) else 0, dtype=_ASKED)
        number = np.empty(len(high), dtype=np.int64)
        number[order] = np.cumsum(new) - 1
        if len(high):
            out["high"], out["low"], out["first"] = high[first], low[first], owners[first]
        shared = owners[first] < owners[last] if len(high) else np.zeros(0, bool)
        return out, shared, number[turn]

    def narrow(self, length: int, bits: np.ndarray) -> None:
        """Keep the windows whose key repeats, after the answers of a level. At the last level a
        window repeats if a smaller document has it, here or elsewhere."""
        asked, shared, number = self.asked(length)
        if length == self.window:
            repeats = bits[number] | (asked["first"][number] < self.owners())
        else:
            repeats = (bits | shared)[number]
        self.alive = self.alive[repeats]

    def results(self) -> pa.Table:
        """A row per document: its words, the spans that go, and the text of those that stay."""
        edge = np.zeros(len(self.hashes) + 1, dtype=np.int64)
        np.add.at(edge, self.alive, 1)
        np.add.at(edge, self.alive + self.window, -1)
        gone = np.cumsum(edge[:-1]) > 0
        bounds = np.searchsorted(self.document, np.arange(len(self.ids) + 1))
        removed, spans, kept = [], [], []
        for text, start, end in zip(
            self.texts, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True
        ):
            here = gone[start:end]
            count = int(here.sum())
            removed.append(count)
            words = text.split()
            if not count:
                spans.append([])
                kept.append(b" ".join(words))
                continue
            turns = np.flatnonzero(np.diff(np.concatenate(([0], here.view(np.int8), [0]))))
            spans.append(
                [
                    {"start": s, "end": e}
                    for s, e in zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True)
                ]
            )
            kept.append(b" ".join(compress(words, (~here).tolist())))
        return pa.Table.from_arrays(
            [
                pa.array(self.ids, pa.int64()),
                pa.array(np.diff(bounds), pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(spans, pa.list_(_SPAN)),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ],
            schema=_RESULT,
        )


def dealt(docs: DataFrame, buckets: int, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, text and chunk of every row, as a table bucketed by chunk.

    A chunk is a stretch of one task's rows, so writing it needs no shuffle."""
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            bytes_of = pc.binary_length(batch.column("text").cast(pa.binary()))
            ends = size + np.cumsum(pc.fill_null(bytes_of, 0).to_numpy(zero_copy_only=False))
            starts = np.concatenate(([size], ends[:-1]))
            size = int(ends[-1]) if len(ends) else size
            chunks = pa.array((chunk + starts // chunk_bytes).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text"), chunks],
                names=["doc_id", "text", "chunk"],
            )

    name = f"substring_dedup_{uuid.uuid4().hex}"
    (
        docs.select(F.col("doc_id").cast("long"), "text")
        .mapInArrow(run, "doc_id long, text string, chunk long")
        .write.bucketBy(buckets, "chunk")
        .option("path", f"{checkpoint_folder(spark)}/{name}")
        .option("compression", "zstd")
        .saveAsTable(name)
    )
    return spark.table(name)


def _narrowed(table: pa.Table, answers: pa.Table, sizes: list[int], window: int) -> Chunk:
    """The chunk after the answers to its first levels."""
    chunk = Chunk.of(table, window)
    rows = answers.sort_by([("level", "ascending"), ("bin", "ascending")])
    levels = rows.column("level").to_numpy()
    bits = rows.column("bits").to_pylist()
    for level, length in enumerate(sizes):
        parts = [
            np.frombuffer(bits[i], dtype=np.uint8) for i in np.flatnonzero(levels == level).tolist()
        ]
        found = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
        chunk.narrow(length, found.astype(bool))
    return chunk


def questions(
    chunks: DataFrame, answers: DataFrame, level: int, sizes: list[int], bins: int
) -> DataFrame:
    """(chunk, bin, keys): what each chunk asks at a level, after the answers to those before."""
    window, length = sizes[-1], sizes[level]

    def ask(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = _narrowed(left, right, sizes[:level], window)
        asked, _, _ = chunk.asked(length)
        place = (asked["high"] >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)
        place = place.astype(np.int64)
        edges = np.flatnonzero(np.diff(place)) + 1
        some = np.split(asked, edges) if len(asked) else []
        number = left.column("chunk")[0].as_py() if left.num_rows else 0
        if length < window:
            keys = [(part["high"] & np.uint64(0xFFFFFFFF)).astype("<u4") for part in some]
        else:
            keys = some
        return pa.Table.from_arrays(
            [
                pa.array([number] * len(some), pa.int64()),
                pa.array(place[np.append(0, edges)] if some else [], pa.int64()),
                pa.array([k.tobytes() for k in keys], pa.binary()),
            ],
            schema=_ASK,
        )

    return (
        chunks.groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(ask, "chunk long, bin long, keys binary")
    )


def answered(asked: DataFrame, level: int, last: bool) -> DataFrame:
    """(chunk, level, bin, bits): for each key of a question, whether another chunk asks about it
    too; at the last level, whether another chunk has it from a smaller document."""

    def answer(table: pa.Table) -> pa.Table:
        keys = table.column("keys").to_pylist()
        width = _ASKED.itemsize if last else 4
        counts = np.array([len(k) // width for k in keys])
        if last:
            rows = np.frombuffer(b"".join(keys), dtype=_ASKED)
            order = np.lexsort((rows["first"], rows["low"], rows["high"]))
            high, low = rows["high"][order], rows["low"][order]
            new = np.ones(len(order), dtype=bool)
            new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
            first = rows["first"][order]
            least = first[np.flatnonzero(new)][np.cumsum(new) - 1]
            yes = least < first
        else:
            values = np.frombuffer(b"".join(keys), dtype="<u4")
            order = np.argsort(values, kind="stable")
            same = np.diff(values[order]) == 0
            yes = np.concatenate(([False], same)) | np.concatenate((same, [False]))
        bits = np.empty(len(order), dtype=np.uint8)
        bits[order] = yes
        parts = np.split(bits, np.cumsum(counts)[:-1])
        return pa.Table.from_arrays(
            [
                table.column("chunk"),
                pa.array([level] * len(keys), pa.int32()),
                table.column("bin"),
                pa.array([p.tobytes() for p in parts], pa.binary()),
            ],
            schema=_ANSWER,
        )

    return asked.groupBy("bin").applyInArrow(answer, "chunk long, level int, bin long, bits binary")


def deduplicated(
    docs: DataFrame,
    window: int = WINDOW,
    shortest: int = SHORTEST,
    chunk_bytes: int = CHUNK_BYTES,
    bin_bytes: int = BIN_BYTES,
) -> DataFrame:
    """A row per document: doc_id, n_words, n_removed, the spans of words that go (from 0, end
    excluded), and the words that stay, joined by one space."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = min(MOST_PARTS, 1 + total // (CHUNKS_A_BUCKET * chunk_bytes))
    bins = min(MOST_PARTS, 1 + total // bin_bytes)
    chunks = dealt(docs, buckets, chunk_bytes)
    sizes = lengths(window, shortest)
    answers = spark.createDataFrame([], "chunk long, level int, bin long, bits binary")
    done = 0
    for level, length in enumerate(sizes):
        asked = questions(chunks, answers, level, sizes, bins)
        found = cut(answered(asked, level, last=length == window))
        answers, done = answers.union(found), level + 1
        if found.isEmpty():
            break

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        return _narrowed(left, right, sizes[:done], window).results()

    return (
        chunks.groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(finish, _RESULT_DDL)
    )
