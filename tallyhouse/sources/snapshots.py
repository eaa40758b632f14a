"""Tables kept as parquet in a shared folder, where every run writes directories of its own.

A table is read while its next state is computed, so nothing is overwritten in place.
Dimensions are written whole by each run that changes them. Orders and the report are split
by month, and a run writes only the months that it changes. What a run leaves alone stays
where an earlier one put it.

All of a run becomes visible by one row appended to the run log, which says when it ran and
what it wrote. After a failure the log still describes the state before, and
repeating the run overwrites what it had left.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.sources.schemas import RUN_LOG

RUN_LOG_NAME = "run_log"
_PART = "month_part"
_RUN, _STAMP = "run", "%Y%m%dT%H%M%S%f"
_NO_MONTH = "none"

# Which run wrote each month of a table, or each table.
Parts = dict[str, dt.datetime]


class SnapshotTables:
    """The tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark = spark
        self._root = root.rstrip("/")

    def write(self, name: str, rows: DataFrame, run_ts: dt.datetime) -> DataFrame:
        """Write a table's state after a run and return it as read from there."""
        path = self._path(name, run_ts)
        rows.write.mode("overwrite").parquet(path)
        return self._spark.read.schema(rows.schema).parquet(path)

    def write_watched(
        self, name: str, rows: DataFrame, run_ts: dt.datetime, watch: dict[str, Column]
    ) -> tuple[DataFrame, dict[str, object]]:
        """As `write`, and what `watch` says of the rows, found by the job that writes them.
        Columns that begin with two underscores are watched and not written."""
        observed, watched = _observed(rows, watch)
        written = self.write(name, observed, run_ts)
        return written, watched.get

    def read(self, name: str, schema: T.StructType, run_ts: dt.datetime | None) -> DataFrame:
        """A table's state after a run; empty before the first one."""
        if run_ts is None:
            return self._empty(schema)
        return self._spark.read.schema(schema).parquet(self._path(name, run_ts))

    def write_months(
        self,
        name: str,
        rows: DataFrame,
        month: Column,
        run_ts: dt.datetime,
        watch: dict[str, Column],
    ) -> dict[str, object]:
        """Write whole months of a table, and return what `watch` says of the rows. Rebalancing
        gives each month few files, and splits a month that is too large for one task."""
        observed, watched = _observed(rows, watch)
        (
            observed.withColumn(_PART, month_part(month))
            .hint("rebalance", _PART)
            .write.mode("overwrite")
            .partitionBy(_PART)
            .parquet(self._path(name, run_ts))
        )
        return watched.get

    def read_months(self, name: str, schema: T.StructType, months: Parts) -> DataFrame:
        """The given months of a table, each from the run that wrote it last."""
        if not months:
            return self._empty(schema)
        paths = [
            f"{self._path(name, run_ts)}/{_PART}={month}" for month, run_ts in months.items()
        ]
        return self._spark.read.schema(schema).parquet(*paths)

    def _empty(self, schema: T.StructType) -> DataFrame:
        """No rows, and known to be none: joins to it are left out of the plan, where otherwise
        the other side would be shuffled for them."""
        return self._spark.createDataFrame([], schema).where(F.lit(False))

    def remove(self, name: str, run_ts: dt.datetime, months: list[str] | None = None) -> None:
        """Delete what a run wrote of a table, or some of its months."""
        path = self._path(name, run_ts)
        for each in [path] if months is None else [f"{path}/{_PART}={m}" for m in months]:
            system, target = self._system(each)
            system.delete(target, True)

    def runs(self, name: str) -> list[dt.datetime]:
        """The runs that left files of a table, finished or not."""
        found = self._listed(f"{self._root}/{name}", _RUN)
        return sorted(dt.datetime.strptime(value, _STAMP) for value in found)

    def months(self, name: str, run_ts: dt.datetime) -> list[str]:
        """The months of which a run left files."""
        return sorted(self._listed(self._path(name, run_ts), _PART))

    def _listed(self, path: str, key: str) -> list[str]:
        """The values of the folders `key`=value below a path."""
        system, target = self._system(path)
        if not system.exists(target):
            return []
        names = [status.getPath().getName() for status in system.listStatus(target)]
        return [name.split("=", 1)[1] for name in names if name.startswith(f"{key}=")]

    def _system(self, path: str) -> tuple:
        """The file system of a path, through Spark's own connection to it."""
        target = self._spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self._spark._jsc.hadoopConfiguration()), target

    def paths(
        self, name: str, run_ts: dt.datetime | None, months: Parts | None = None
    ) -> list[str]:
        """Where a table's state lies: that of a run, or the given months."""
        if months is not None:
            return [f"{self._path(name, ts)}/{_PART}={month}" for month, ts in months.items()]
        return [] if run_ts is None else [self._path(name, run_ts)]

    def publish(self, name: str, schema: T.StructType, paths: list[str]) -> None:
        """A view in the catalog over files of one schema. All paths are one relation, so a query
        plans one scan, however many months there are."""
        nothing = ", ".join(
            f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields
        )
        names = ", ".join(f"`{f.name}`" for f in schema.fields)
        below = [path.removeprefix(f"{self._root}/") for path in paths]
        where = below[0] if len(below) == 1 else "{" + ",".join(below) + "}"
        body = f"SELECT {names} FROM parquet.`{self._root}/{where}`" if paths else None
        self._spark.sql(
            f"CREATE OR REPLACE VIEW {name} AS {body or f'SELECT {nothing} WHERE false'}"
        )

    def log_path(self) -> str:
        return f"{self._root}/{RUN_LOG_NAME}"

    def log(self) -> DataFrame:
        """The run log, which is created empty if it does not exist."""
        path = self.log_path()
        self._spark.createDataFrame([], RUN_LOG).write.mode("ignore").parquet(path)
        return self._spark.read.schema(RUN_LOG).parquet(path)

    def append_log(self, entry: DataFrame) -> None:
        entry.coalesce(1).write.mode("append").parquet(self.log_path())

    def _path(self, name: str, run_ts: dt.datetime) -> str:
        return f"{self._root}/{name}/{_RUN}={run_ts.strftime(_STAMP)}"


def latest_parts(log: DataFrame, column: str) -> Parts:
    """The last run that wrote each of the parts listed in a column of the log."""
    written = log.select("run_ts", F.explode(column).alias("part"))
    latest = written.groupBy("part").agg(F.max("run_ts").alias("run_ts"))
    return {row.part: row.run_ts for row in latest.collect()}


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one that the session names: `spark.checkpoint.dir`, or else its
    warehouse, which executors and a restarted driver share as well."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.sql.warehouse.dir"
    )
    return f"{shared.rstrip('/')}/tallyhouse/{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"


def month_part(month: Column) -> Column:
    """A month as `write_months` names it. There can be no more than the calendar has."""
    return F.coalesce(month, F.lit(_NO_MONTH))


def _observed(rows: DataFrame, watch: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """The rows, watched by whatever job computes them first."""
    watched = Observation()
    seen = rows.observe(watched, *[metric.alias(name) for name, metric in watch.items()])
    return seen.select([c for c in rows.columns if not c.startswith("__")]), watched
