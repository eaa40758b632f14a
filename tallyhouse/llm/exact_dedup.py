"""Exact duplicates by content-defined chunk recipes.

Texts are equal when they are identical after lower-casing A-Z; null counts as empty. A text is
cut where a gear hash of its last 64 bytes says so, so equal texts have equal chunks. A task
sends each different chunk of its documents once, to verify that its digest stands for one content;
after that only lists of chunk identifiers are compared. `keep_one` returns whole rows, of which a
task sends one for each different text.

Edge cases: null and empty texts are equal and have an empty list. A null doc_id loses to any
other. Of rows that repeat a doc_id and a text `exact_groups` marks each as kept or each as not,
and `keep_one` keeps exactly one row of each group of equal texts, whatever their ids. An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.shared import cut, row_groups
from tallyhouse.llm.words import mix

#: Bytes: the least and largest size of a chunk; a cut is due every `MEAN` bytes on average.
LEAST, MEAN, MOST = 256, 2048, 16384
#: Bytes of a chunk's digest.
DIGEST = 16
_RECIPE, _SHA = "__recipe", "__text_sha256"
_GEAR = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def chunk_ends(data: bytes) -> list[int]:
    """Where the chunks of the bytes end."""
    if len(data) <= LEAST:
        return [len(data)] if data else []
    gear = _GEAR[np.frombuffer(data, dtype=np.uint8)]
    for step in (1, 2, 4, 8, 16, 32):
        gear[step:] = gear[step:] + (gear[:-step] << np.uint64(step))
    ends, last = [], 0
    for end in [*(np.flatnonzero(gear >> np.uint64(53) == 0) + 1).tolist(), len(data)]:
        while end - last > MOST:
            last += MOST
            ends.append(last)
        if end - last >= LEAST or end == len(data) and end > last:
            ends.append(end)
            last = end
    return ends


def chunks_of(data: bytes, digest_bytes: int = DIGEST) -> list[tuple[bytes, bytes]]:
    """Digest and content of each chunk, in order."""
    out, start = [], 0
    for end in chunk_ends(data):
        body = data[start:end]
        out.append((xxhash.xxh3_128_digest(body)[:digest_bytes], body))
        start = end
    return out


def _normalised(batch: pa.RecordBatch) -> list[bytes]:
    texts = batch.column("text").cast(pa.binary()).to_pylist()
    return [(text or b"").translate(_LOWER) for text in texts]


def recipes(docs: DataFrame, digest_bytes: int = DIGEST) -> DataFrame:
    """The rows with the digests of their texts' chunks in one string of bytes, and the SHA-256 of
    the text."""
    names = [*docs.columns, _RECIPE, _SHA]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_groups(batches, "text"):
            texts = _normalised(batch)
            lists = [b"".join(d for d, _ in chunks_of(t, digest_bytes)) for t in texts]
            digests = [hashlib.sha256(t).hexdigest() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lists, pa.binary()), pa.array(digests, pa.string())],
                names=names,
            )

    more = [T.StructField(_RECIPE, T.BinaryType()), T.StructField(_SHA, T.StringType())]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *more]))


def chunks(docs: DataFrame, digest_bytes: int = DIGEST) -> DataFrame:
    """SHA-256 of the text, place, digest and content of every chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_groups(batches, "text"):
            rows = [
                (hashlib.sha256(text).hexdigest(), place, digest, body)
                for text in _normalised(batch)
                for place, (digest, body) in enumerate(chunks_of(text, digest_bytes))
            ]
            kinds = (pa.string(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)],
                names=[_SHA, "place", "digest", "body"],
            )

    return docs.select("text").mapInArrow(
        run, f"{_SHA} string, place int, digest binary, body binary"
    )


def verified(rows: DataFrame, docs: DataFrame, digest_bytes: int = DIGEST) -> DataFrame:
    """The rows of `recipes` in which equal lists mean equal texts: where a digest stands for more
    than one content, the list also names which of them it is. What is added depends on the text
    alone, so ids may repeat or be missing."""
    contents = chunks(docs, digest_bytes).groupBy("digest", "body").agg(F.count("*").alias("n"))
    clashing = cut(
        contents.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")
    )
    if clashing.isEmpty():
        return rows
    told_apart = cut(
        contents.join(clashing, "digest").select(
            "digest",
            "body",
            F.row_number().over(Window.partitionBy("digest").orderBy("body")).alias("which"),
        )
    )
    notes = (
        chunks(docs, digest_bytes)
        .join(told_apart, ["digest", "body"])
        .groupBy(_SHA)
        .agg(F.sort_array(F.collect_set(F.struct("place", "which"))).alias("__notes"))
    )
    told = F.concat(_RECIPE, F.coalesce(F.to_json("__notes"), F.lit("")).cast("binary"))
    return rows.join(notes, _SHA, "left").withColumn(_RECIPE, told).select(*rows.columns)


def exact_groups(docs: DataFrame, digest_bytes: int = DIGEST) -> DataFrame:
    """A row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest doc_id stays."""
    found = recipes(docs.select("doc_id", "text"), digest_bytes).drop("text")
    rows = verified(cut(found), docs, digest_bytes)
    groups = cut(
        rows.groupBy(_RECIPE)
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .where("group_size > 1")
    )
    return rows.join(groups, _RECIPE, "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id"))
        .otherwise(F.col("keep_id"))
        .alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.when(F.col("group_size").isNull(), F.lit(True))
        .otherwise(F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .alias("kept"),
        F.col(_SHA).alias("text_sha256"),
    )


def keep_one(docs: DataFrame, digest_bytes: int = DIGEST) -> DataFrame:
    """The documents without exact duplicates, with all their columns: of equal texts exactly one
    row stays, one with the largest doc_id. Rows are ranked before they move, so a text that a
    third of all rows have is sent once by each task."""
    rows = verified(recipes(docs, digest_bytes), docs, digest_bytes)
    best = Window.partitionBy(_RECIPE).orderBy(F.col("doc_id").desc_nulls_last())
    return rows.withColumn("__rank", F.row_number().over(best)).where("__rank = 1").select(
        *docs.columns
    )
