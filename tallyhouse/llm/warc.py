"""WARC archives of pages, and a two-level index of their captures.

Archives are written by Spark's text writer: a record is one value, and the two line ends that
close a WARC record are the line separator, so files commit like any other table and hold whole,
uncompressed records that can be read by range. Of records with equal payloads of at least 100
bytes the one with the smallest page_id is a response; the others revisit it and hold no payload.

The index sorts the captures by key (host reversed, then path and query, then the record) into
blocks of lines that are compressed one by one. A sparse directory has the first key of each block.
A lookup searches the bounds of the index's parts, then the part's directory, then one block, and
then reads the record's range of the archive, through any file system that pyarrow reaches.

Edge cases: a null html is an empty payload and a null url an empty one; white space and control
characters in a url become %20. Payloads below 100 bytes are always responses. Rows that repeat a
page_id are records of their own; if they come first they are all responses. Empty tables give
empty archives.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.shared import checked, checkpoint_folder, cut, stored

#: Bytes of a payload from which on equal payloads are stored once.
LEAST_BYTES = 100
#: Records of an archive file; lines of a block of the index; records of a part of the index.
FILE_RECORDS, BLOCK_LINES, PART_RECORDS = 1000, 256, 200_000
WARC_DATE = "2024-01-01T00:00:00Z"
_END = "\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CAPTURE = (
    "key string, page_id long, url string, record_type string, payload_bytes long, "
    "payload_digest string, refers_to long, refers_key string, file string, "
    "start long, length long"
)


def with_records(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, its bytes and digest, and what the record revisits, if anything."""
    url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7f]", "%20")
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(
        "page_id",
        url.alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha2(payload.cast("binary"), 256).alias("payload_digest"),
    )
    # The payloads stay where they are unless there are very many that occur more than once.
    numbered = F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))
    firsts = cut(
        rows.where(F.col("payload_bytes") >= LEAST_BYTES)
        .groupBy("payload_digest")
        .agg(F.min(numbered).alias("first"), F.count("*").alias("n"))
        .where("n > 1 and first is not null")
        .select(
            "payload_digest",
            F.col("first.page_id").alias("first_id"),
            F.col("first.url").alias("first_url"),
        )
    )
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.join(checked(firsts), "payload_digest", "left").select(
        "page_id",
        "url",
        "payload",
        "payload_bytes",
        "payload_digest",
        F.when(revisit, F.col("first_id")).alias("refers_to"),
        F.when(revisit, F.col("first_url")).alias("refers_url"),
    )


def record(row_type: Column) -> Column:
    """The record of a row of `with_records`, without the two line ends that close it."""
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_END}Content-Type: text/html; charset=utf-8{_END}"),
        F.concat(F.lit("Content-Length: "), F.col("payload_bytes").cast("string")),
        F.lit(_END * 2),
        F.when(row_type == "response", F.col("payload")).otherwise(""),
    )

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(_END))

    revisits = F.concat(
        line("WARC-Profile", F.lit(_PROFILE)),
        line("WARC-Refers-To", _urn("refers_to")),
        line("WARC-Refers-To-Target-URI", F.col("refers_url")),
    )
    return F.concat(
        F.lit(f"WARC/1.1{_END}"),
        line("WARC-Type", row_type),
        line("WARC-Record-ID", _urn("page_id")),
        line("WARC-Date", F.lit(WARC_DATE)),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        F.when(row_type == "revisit", revisits).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(http).cast("string")),
        F.lit(_END),
        http,
    )


def _urn(name: str) -> Column:
    number = F.coalesce(F.col(name).cast("string"), F.lit(""))
    return F.concat(F.lit("<urn:page:"), number, F.lit(">"))


def write_archives(pages: DataFrame) -> str:
    """Write the archives below the shared folder and return theirs."""
    folder = f"{checkpoint_folder(pages.sparkSession)}/warc-{uuid.uuid4()}"
    row_type = F.when(F.col("refers_to").isNull(), "response").otherwise("revisit")
    with_records(pages).select(record(row_type).alias("value")).write.option(
        "lineSep", _END * 2
    ).option("maxRecordsPerFile", FILE_RECORDS).text(folder)
    return folder


def parse_record(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """The header, the block, and the end of the record that begins at `at`."""
    end = data.index(b"\r\n\r\n", at)
    first, *lines = data[at:end].decode().split(_END)
    if first != "WARC/1.1":
        raise ValueError(f"no WARC record at {at}")
    header = dict(line.split(": ", 1) for line in lines)
    start = end + 4
    stop = start + int(header["Content-Length"])
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise ValueError(f"the record at {at} does not end where it says")
    return header, data[start:stop], stop + 4


def payload_of(block: bytes) -> tuple[int, bytes]:
    """The payload's length as the HTTP header has it, and what the block holds of it."""
    head, _, payload = block.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split(_END)[1:])
    return int(fields["Content-Length"]), payload


def url_key(url: str) -> str:
    """The host with its labels reversed, then path and query: com,example,www)/path?query."""
    rest = url.split("://", 1)[-1].split("#", 1)[0]
    cut_at = min((rest.find(c) for c in "/?" if c in rest), default=len(rest))
    host, port = rest[:cut_at].rpartition("@")[2].lower(), ""
    if ":" in host:
        host, port = host.split(":", 1)
    reversed_host = ",".join(reversed(host.split(".")))
    return f"{reversed_host}{':' + port if port else ''}){rest[cut_at:] or '/'}"


def capture_key(url: str, page_id: int | None) -> str:
    return f"{url_key(url)} {'' if page_id is None else page_id}"


def _number(urn: str | None) -> int | None:
    digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def captures(folder: DataFrame) -> DataFrame:
    """Every record of archive files (path, content): its key, what it says, and its range.

    A response's payload is digested anew; one that differs from its header is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(
                batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True
            ):
                rows, at = [], 0
                while at < len(content):
                    header, block, end = parse_record(content, at)
                    size, payload = payload_of(block)
                    digest = header["WARC-Payload-Digest"].removeprefix("sha256:")
                    kind = header["WARC-Type"]
                    found = hashlib.sha256(payload).hexdigest()
                    if kind == "response" and (found, len(payload)) != (digest, size):
                        raise ValueError(f"damaged record at {at} of {path}")
                    page_id = _number(header["WARC-Record-ID"])
                    refers_to = _number(header.get("WARC-Refers-To"))
                    target = header.get("WARC-Refers-To-Target-URI")
                    url = header["WARC-Target-URI"]
                    refers_key = None if target is None else capture_key(target, refers_to)
                    rows.append(
                        (capture_key(url, page_id), page_id, url, kind, size, digest,
                         refers_to, refers_key, path, at, end - at)
                    )
                    at = end
                yield _batch(rows, _CAPTURE)

    return folder.select("path", "content").mapInArrow(run, _CAPTURE)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [field.split() for field in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([row[i] for row in rows], kinds[kind]) for i, (_, kind) in enumerate(fields)],
        names=[name for name, _ in fields],
    )


class CaptureIndex:
    """Blocks of the sorted captures, and the first key of each part."""

    _SCHEMA = "part int, block int, first_key string, n int, data binary"

    def __init__(self, found: DataFrame, block_lines: int = BLOCK_LINES) -> None:
        spark = found.sparkSession
        parts = max(1, -(-found.count() // PART_RECORDS))
        lines = found.select("key", F.to_json(F.struct("file", "start", "length")).alias("line"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part, block = TaskContext.get().partitionId(), 0
            waiting: list[tuple[str, str]] = []
            for batch in batches:
                waiting += zip(*(c.to_pylist() for c in batch.columns), strict=True)
                while len(waiting) >= block_lines:
                    yield _batch([_block(part, block, waiting[:block_lines])], self._SCHEMA)
                    waiting, block = waiting[block_lines:], block + 1
            if waiting:
                yield _batch([_block(part, block, waiting)], self._SCHEMA)

        ordered = lines.repartitionByRange(parts, "key").sortWithinPartitions("key", "line")
        self.blocks = stored(ordered.mapInArrow(run, self._SCHEMA))
        self.directory = self.blocks.select("part", "block", "first_key")
        bounds = self.directory.groupBy("part").agg(F.min("first_key").alias("first_key"))
        rows = sorted((row["first_key"], row["part"]) for row in bounds.collect())
        self.bounds = spark.sparkContext.broadcast(rows)

    def locate(self, keys: DataFrame) -> DataFrame:
        """key, file, start and length of the captures with the given distinct keys."""
        bounds = self.bounds

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            firsts = [first for first, _ in bounds.value]
            for batch in batches:
                names = batch.column("key").to_pylist()
                at = [max(0, bisect_right(firsts, key) - 1) for key in names]
                places = zip(names, at, strict=True) if firsts else ()
                rows = [(key, bounds.value[i][1]) for key, i in places]
                yield _batch(rows, "key string, part int")

        def search(part: tuple, wanted: pd.DataFrame, directory: pd.DataFrame) -> pd.DataFrame:
            if directory.empty:
                return pd.DataFrame({"key": [], "part": [], "block": []})
            directory = directory.sort_values("block")
            firsts = directory["first_key"].tolist()
            at = [max(0, bisect_right(firsts, key) - 1) for key in wanted["key"]]
            blocks = directory["block"].to_numpy()
            return pd.DataFrame({"key": wanted["key"], "part": part[0], "block": blocks[at]})

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            last: tuple = (None, [], [])
            for batch in batches:
                rows = []
                for key, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if data != last[0]:
                        lines = zlib.decompress(data).decode().split("\n")
                        pairs = [line.split("\t", 1) for line in lines]
                        last = (data, [p[0] for p in pairs], [p[1] for p in pairs])
                    at = bisect_left(last[1], key)
                    if at < len(last[1]) and last[1][at] == key:
                        rows.append((key, last[2][at]))
                yield _batch(rows, "key string, line string")

        routed = keys.select("key").mapInArrow(route, "key string, part int")
        placed = routed.groupBy("part").cogroup(self.directory.groupBy("part")).applyInPandas(
            search, "key string, part int, block int"
        )
        lines = (
            placed.join(self.blocks.select("part", "block", "data"), ["part", "block"])
            .select("key", "data")
            .mapInArrow(read, "key string, line string")
        )
        place = F.from_json("line", "file string, start long, length long").alias("place")
        return lines.select("key", place).select("key", "place.*")


def _block(part: int, block: int, lines: list[tuple[str, str]]) -> tuple:
    text = "\n".join(f"{key}\t{line}" for key, line in lines)
    return (part, block, lines[0][0], len(lines), zlib.compress(text.encode()))


def payloads(places: DataFrame) -> DataFrame:
    """key and payload of records (key, file, start, length), by range reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: tuple = (None, None)
        for batch in batches:
            for key, file, start, length in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if file != opened[0]:
                    system, path = fs.FileSystem.from_uri(file)
                    opened = (file, system.open_input_file(path))
                opened[1].seek(start)
                _, block, _ = parse_record(opened[1].read(length))
                yield _batch([(key, payload_of(block)[1])], "key string, payload binary")

    near = places.select("key", "file", "start", "length")
    return near.sortWithinPartitions("file", "start").mapInArrow(
        run, "key string, payload binary"
    )


def read_archives(pages: DataFrame, folder: str) -> DataFrame:
    """The captures of the archives in a folder."""
    return captures(pages.sparkSession.read.format("binaryFile").load(folder))


def archived(pages: DataFrame) -> DataFrame:
    """Write the pages as archives, read them back, and say for each record what it is.

    The payload of a revisit is that of the response it names, found through the index."""
    found = cut(read_archives(pages, write_archives(pages)).drop("url"))
    index = CaptureIndex(found)
    wanted = found.where("refers_key is not null").select(F.col("refers_key").alias("key"))
    fetched = cut(
        payloads(index.locate(wanted.distinct())).select(
            F.col("key").alias("refers_key"),
            F.octet_length("payload").cast("long").alias("bytes"),
            F.sha2("payload", 256).alias("digest"),
        )
    )
    return found.join(fetched, "refers_key", "left").select(
        "page_id",
        F.when(F.col("record_type") == "revisit", F.col("bytes"))
        .otherwise(F.col("payload_bytes"))
        .alias("payload_bytes"),
        F.when(F.col("record_type") == "revisit", F.col("digest"))
        .otherwise(F.col("payload_digest"))
        .alias("payload_digest"),
        "record_type",
        "refers_to",
    )
