"""Reading the two source tables: whole, or the files that are new."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPOCH = dt.datetime(1970, 1, 1)
_FILES = "*.parquet"


def read_source(spark: SparkSession, where: str, schema: T.StructType) -> DataFrame:
    """A source table in its declared types, from a parquet folder or the catalog. `where`
    is taken as a folder when it contains a slash. Columns that are not declared are not
    read."""
    return _declared(
        spark.read.parquet(where) if "/" in where else spark.table(where), where, schema
    )


def read_new_files(
    spark: SparkSession, folder: str, schema: T.StructType, after: dt.datetime | None
) -> tuple[DataFrame, dt.datetime | None]:
    """The rows of the files of a source folder that were written after a time (all files if it is
    None), and the time up to which files were taken, in UTC: the time to go on from.

    Only the folder is listed to find that time. A file that arrives while the rows are read is
    later than it, and so is left to the next run as a whole. Files are never changed in place."""
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", _FILES)
        .option("recursiveFileLookup", "true")
        .load(folder)
        .agg(F.max(F.unix_millis("modificationTime")))
        .first()[0]
    )
    until = after if listed is None else _EPOCH + dt.timedelta(milliseconds=listed)
    if until is None or after is not None and until <= after:
        return spark.createDataFrame([], schema), after
    files = spark.read.option("pathGlobFilter", _FILES).option("timeZone", "UTC")
    files = files.option("modifiedBefore", _option(until + dt.timedelta(milliseconds=1)))
    if after is not None:
        files = files.option("modifiedAfter", _option(after))
    return _declared(files.parquet(folder), folder, schema), until


def _declared(frame: DataFrame, where: str, schema: T.StructType) -> DataFrame:
    missing = [name for name in schema.names if name not in frame.columns]
    if missing:
        raise ValueError(f"{where} lacks the columns {missing}")
    return frame.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _option(time: dt.datetime) -> str:
    return time.isoformat(timespec="milliseconds")
