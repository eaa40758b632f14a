"""Reading tables, cutting lineage, and batches of rows for functions over Arrow."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows that are sent to all tasks at most.
FEW_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder that `spark.checkpoint.dir` names.

    Only a local session (tests) may lack the setting; it gets a folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that executors share")
        folder = tempfile.mkdtemp(prefix="tallyhouse-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def cut(frame: DataFrame) -> DataFrame:
    """The frame, computed once and kept in the session's checkpoint folder."""
    checkpoint_folder(frame.sparkSession)
    return frame.checkpoint()


def stored(frame: DataFrame) -> DataFrame:
    """The frame as compressed Parquet in the checkpoint folder, for what holds texts."""
    spark = frame.sparkSession
    path = f"{checkpoint_folder(spark)}/stored-{uuid.uuid4()}"
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def checked(frame: DataFrame, most: int = FEW_ROWS) -> DataFrame:
    """The frame with a hint to broadcast it if it has few rows. Its rows must be small, and it
    must have been cut, as it is counted here. A larger frame is joined by a shuffle."""
    return F.broadcast(frame) if frame.count() <= most else frame


def filtered(frame: DataFrame, keep: Callable[[list[str | None]], list[bool]]) -> DataFrame:
    """The rows whose text `keep` wants, whole and in one pass: no row is joined or shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in row_groups(iter([batch]), "text"):
                yield some.filter(pa.array(keep(some.column("text").to_pylist()), pa.bool_()))

    return frame.mapInArrow(run, frame.schema)


def row_groups(
    batches: Iterator[pa.RecordBatch], text_column: str, most_chars: int = 2_000_000
) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most `most_chars` characters of text (or one row), so that
    work arrays over a slice stay small whatever the batch size. Rows are neither cut nor dropped.
    """
    for batch in batches:
        start, chars = 0, 0
        lengths = [len(x or "") for x in batch.column(text_column).to_pylist()]
        for row, length in enumerate(lengths):
            if row > start and chars + length > most_chars:
                yield batch.slice(start, row - start)
                start, chars = row, 0
            chars += length
        if start < batch.num_rows:
            yield batch.slice(start)
