"""The incremental refresh: deliveries in, star and report snapshots out."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.columns import moment, report_month
from tallyhouse.operators.changes import (
    FIRST_MARK,
    affected_summary,
    day_mark,
    delta,
    exact_mark,
    latest_mark,
    measured_if_unknown,
    orders_in,
)
from tallyhouse.operators.checks import (
    check_merge_cardinality,
    check_pk,
    months_seen,
    refuse,
    set_of,
    watch_of,
    watched_nulls,
    with_alike,
)
from tallyhouse.operators.star import Star
from tallyhouse.operators.upsert import changed_rows, latest_per_key, overwrite, unmatched
from tallyhouse.plans.report import conform_report, report_rows, with_report_ids
from tallyhouse.plans.star_load import (
    CRAFTSMAN,
    CUSTOMER,
    ORDER,
    PRODUCT,
    STAR_TABLES,
    StarTable,
    merge,
    source_rows,
)
from tallyhouse.sources.schemas import (
    CUSTOMER_ATTRIBUTES,
    CUSTOMER_REPORT,
    REPORT_COLUMNS,
    REPORT_KEY,
    RUN_LOG,
    required_columns,
    widened,
)
from tallyhouse.sources.snapshots import (
    RUN_LOG_NAME,
    Parts,
    SnapshotTables,
    latest_parts,
    month_part,
)

REPORT = "customer_report_datamart"


@dataclass(frozen=True)
class LastRun:
    """What the log says about the runs so far."""

    runs: int = 0
    run_ts: dt.datetime | None = None
    load_dttm: dt.date = FIRST_MARK
    mark_ts: dt.datetime | dt.date = FIRST_MARK
    last_report_id: int = 0
    orders_read: dt.datetime | None = None
    customers_read: dt.datetime | None = None
    dimensions: Parts = field(default_factory=dict)
    order_months: Parts = field(default_factory=dict)
    report_months: Parts = field(default_factory=dict)


@dataclass(frozen=True)
class Refresh:
    """How refreshes are run.

    `exact_mark` keeps the mark at full precision. Without it the mark is a day, which
    lies before the stamps of its own batch, so that each run also repeats the last
    batch: right, but wide. `only_if_changed` leaves rows that came unchanged untouched.
    `keep_latest` takes the latest of several source rows for one craftsman, where the
    default is to refuse them. `wide_keys` is for more customers than an INT can number.
    """

    spark: SparkSession
    root: str
    exact_mark: bool = False
    only_if_changed: bool = False
    keep_latest: bool = False
    wide_keys: bool = False

    @property
    def tables(self) -> SnapshotTables:
        return SnapshotTables(self.spark, self.root)

    def run(
        self,
        craft_products_orders: DataFrame,
        customers: DataFrame,
        run_ts: dt.datetime,
        rebuild: bool = False,
        orders_read: dt.datetime | None = None,
        customers_read: dt.datetime | None = None,
    ) -> DataFrame:
        """Merge one delivery into the star, bring the report up to date, move the mark.
        Returns the report. Each run needs a later `run_ts` than the one before. `rebuild`
        starts over from the delivery alone: what earlier runs left is not read again.
        `orders_read` and `customers_read` are noted in the log for the next run."""
        last = self.last_run()
        if last.run_ts is not None and last.run_ts >= run_ts:
            raise ValueError(f"run_ts {run_ts} is not later than the last run, {last.run_ts}")
        if rebuild:
            last = LastRun(runs=last.runs)
        written = self.merge_delivery(craft_products_orders, customers, last, run_ts)
        star = self._star_after(last, written, run_ts)

        affected, seen = self._affected(star, last, written, run_ts)
        order_parts = dict.fromkeys(written[ORDER], run_ts)
        report_months, last_id = self._refresh_report(
            star, affected, seen, last, order_parts, run_ts
        )
        self.tables.append_log(
            self.spark.range(1).select(
                F.lit(last.runs + 1).cast("bigint").alias("id"),
                F.lit(seen["load_dttm"]).cast("date").alias("load_dttm"),
                F.lit(seen["mark_ts"]).cast("timestamp_ntz").alias("mark_ts"),
                moment(run_ts).alias("run_ts"),
                F.lit(last_id).cast("bigint").alias("last_report_id"),
                _names([t.name for t in STAR_TABLES if t is not ORDER and written[t]]).alias(
                    "dimensions"
                ),
                _names(written[ORDER]).alias("order_months"),
                _names(report_months).alias("report_months"),
                F.lit(rebuild).alias("rebuilt"),
                _time(orders_read or last.orders_read).alias("orders_read"),
                _time(customers_read or last.customers_read).alias("customers_read"),
            )
        )
        return self.tables.read_months(
            REPORT,
            self._report_schema(),
            last.report_months | dict.fromkeys(report_months, run_ts),
        )

    def report(self) -> DataFrame:
        """The report as of the last finished run."""
        return self.tables.read_months(
            REPORT, self._report_schema(), self.last_run().report_months
        )

    def star(self) -> Star:
        """The star as of the last finished run."""
        return self._star_after(self.last_run())

    def publish(self, database: str) -> None:
        """Views of the star tables, the report and the run log as of the last run, under their
        names in a database of the session's catalog. A later run publishes anew."""
        last = self.last_run()
        for table in STAR_TABLES:
            parts = last.order_months if table is ORDER else last.dimensions
            months = parts if table is ORDER else None
            run_ts = None if table is ORDER else parts.get(table.name)
            self._publish(database, table.name, table.schema, run_ts, months)
        self._publish(database, REPORT, self._report_schema(), None, last.report_months)
        self.tables.publish(f"{database}.{RUN_LOG_NAME}", RUN_LOG, [self.tables.log_path()])

    def _publish(
        self,
        database: str,
        name: str,
        schema: T.StructType,
        run_ts: dt.datetime | None,
        months: Parts | None,
    ) -> None:
        paths = self.tables.paths(name, run_ts, months)
        self.tables.publish(f"{database}.{name}", schema, paths)

    def clean(self) -> None:
        """Delete what the log does not name: the stages of all runs, the parts that a later run has
        written anew, and all that runs left which did not finish. The folders are listed, so a run
        that died is found without being repeated, and what is gone is not looked for again. No run
        may be under way, and readers of an earlier state must be done."""
        last = self.last_run()
        stages = [f"{t.name}_{kind}" for t in STAR_TABLES for kind in ("source", "changes")]
        for name in [*stages, "affected_months", "report_rows", "report_changes"]:
            for run_ts in self.tables.runs(name):
                self.tables.remove(name, run_ts)
        for name in [t.name for t in STAR_TABLES if t is not ORDER]:
            for run_ts in self.tables.runs(name):
                if last.dimensions.get(name) != run_ts:
                    self.tables.remove(name, run_ts)
        for name, current in ((ORDER.name, last.order_months), (REPORT, last.report_months)):
            for run_ts in self.tables.runs(name):
                kept = {month for month, ts in current.items() if ts == run_ts}
                old = [month for month in self.tables.months(name, run_ts) if month not in kept]
                self.tables.remove(name, run_ts, old if kept else None)

    def last_run(self) -> LastRun:
        log = self.tables.log()
        rebuilt = log.where("rebuilt").agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
        log = log.where(F.col("id") >= rebuilt)
        latest = log.agg(
            F.coalesce(F.max("id"), F.lit(0)).alias("runs"),
            F.max("run_ts").alias("run_ts"),
            latest_mark("load_dttm", "date"),
            latest_mark("mark_ts", "timestamp_ntz"),
            F.coalesce(F.max("last_report_id"), F.lit(0)).alias("last_report_id"),
            F.max("orders_read").alias("orders_read"),
            F.max("customers_read").alias("customers_read"),
        ).first()
        return LastRun(
            **latest.asDict(),
            **{
                column: latest_parts(log, column)
                for column in ("dimensions", "order_months", "report_months")
            },
        )

    def merge_delivery(
        self,
        craft_products_orders: DataFrame,
        customers: DataFrame,
        last: LastRun,
        run_ts: dt.datetime,
    ) -> dict[StarTable, list[str]]:
        """Write what a delivery changes in the star. Returns the parts written of each
        table: months of orders, or the table's name."""

        def merge_one(table: StarTable) -> list[str]:
            rows = source_rows(table, craft_products_orders, customers, dealt_by_key=True)
            return self._merge_table(table, rows, last, run_ts)

        # The four tables do not depend on each other: their jobs may share the cluster.
        with ThreadPoolExecutor(len(STAR_TABLES)) as pool:
            return dict(zip(STAR_TABLES, pool.map(merge_one, STAR_TABLES)))

    def _merge_table(
        self, table: StarTable, rows: DataFrame, last: LastRun, run_ts: dt.datetime
    ) -> list[str]:
        rows, seen = self._incoming(table, rows, run_ts)
        target = self._reached(table, seen, last)
        # The source alone tells whether it has double keys; the target is asked only then.
        if seen["alike"] > 1:
            refuse(
                check_merge_cardinality(target, rows, table.natural_key),
                f"{table.name}: several source rows for one target row",
            )
        if self.only_if_changed and last.run_ts is not None:
            compared = [name for name in table.schema.names if name != "load_dttm"]
            rows, seen = self.tables.write_watched(
                f"{table.name}_changes",
                changed_rows(
                    rows.select(*compared), target.select(*compared), table.natural_key
                ),
                run_ts,
                watch_of(month=_month_of(table), key=table.key),
            )
            target = self._reached(table, seen, last)
        if not seen["rows"]:
            return []
        merged = merge(table, target, rows, run_ts, self.only_if_changed)
        if table is ORDER:
            written = months_seen(seen["months"])
            self.tables.write_months(table.name, merged, _order_month(), run_ts, watch_of())
            # An id is unique over all months. Only files whose range of ids meets that of the
            # rows have to be read for it.
            near = F.col(table.key).between(seen["low"], seen["high"])
            doubled = True
        else:
            written, near = [table.name], F.lit(True)
            counted = with_alike(merged, [table.key])
            _, after = self.tables.write_watched(
                table.name, counted, run_ts, watch_of(alike=True)
            )
            doubled = after["alike"] > 1
        if doubled:
            whole = self._after(table, last, written, run_ts).where(near)
            refuse(check_pk(whole, [table.key], among=rows), f"{table.name}: double keys")
        return written

    def _incoming(
        self, table: StarTable, rows: DataFrame, run_ts: dt.datetime
    ) -> tuple[DataFrame, dict[str, object]]:
        """The distinct source rows of a table, written because two joins read them, and what the
        checks and the merge need to know of them, from the same job."""
        if self.keep_latest and "load_dttm" in rows.columns:
            rows = latest_per_key(rows, table.natural_key, by="load_dttm")
        required = [c for c in required_columns(table.schema) if c in rows.columns]
        written, seen = self.tables.write_watched(
            f"{table.name}_source",
            with_alike(rows, table.natural_key),
            run_ts,
            watch_of(required, alike=True, month=_month_of(table), key=table.key),
        )
        refuse(watched_nulls(seen), f"{table.name}: required columns without a value")
        return written, seen

    def _reached(self, table: StarTable, seen: dict[str, object], last: LastRun) -> DataFrame:
        """The part of a table that rows may match. Orders match on their creation day
        among others, so that it is the months the rows are of."""
        if table is not ORDER:
            return self._after(table, last)
        months = _only(last.order_months, months_seen(seen["months"]))
        return self.tables.read_months(table.name, table.schema, months)

    def _after(
        self,
        table: StarTable,
        last: LastRun,
        written: list[str] | None = None,
        run_ts: dt.datetime | None = None,
    ) -> DataFrame:
        """A whole star table after the last run, and after the parts written since."""
        fresh = dict.fromkeys(written or [], run_ts)
        if table is ORDER:
            return self.tables.read_months(
                table.name, table.schema, last.order_months | fresh
            )
        return self.tables.read(
            table.name, table.schema, (last.dimensions | fresh).get(table.name)
        )

    def _star_after(
        self,
        last: LastRun,
        written: dict[StarTable, list[str]] | None = None,
        run_ts: dt.datetime | None = None,
    ) -> Star:
        craftsman, product, customer, order = [
            self._after(t, last, (written or {}).get(t), run_ts)
            for t in (CRAFTSMAN, PRODUCT, CUSTOMER, ORDER)
        ]
        return Star(craftsman, product, customer, order)

    def _affected(
        self,
        star: Star,
        last: LastRun,
        written: dict[StarTable, list[str]],
        run_ts: dt.datetime,
    ) -> tuple[DataFrame, dict[str, object]]:
        """The customer months that the delta touches, written, with the months to measure anew,
        the months to describe anew, and the next marks."""
        mark = last.mark_ts if self.exact_mark else last.load_dttm
        touched, among = self._delta(star, mark, last, written, run_ts)
        summary = affected_summary(touched, mark)
        if "customer" in among:
            known = self.tables.read_months(REPORT, self._report_schema(), last.report_months)
            summary = measured_if_unknown(summary, known)
        month = month_part(F.col("report_month"))
        return self.tables.write_watched(
            "affected_months",
            summary,
            run_ts,
            {
                "measured": set_of(F.when(F.col("measured"), month)),
                "described": set_of(F.when(~F.col("measured"), month)),
                "load_dttm": day_mark(run_ts).cast("string"),
                "mark_ts": exact_mark(mark).cast("string"),
            },
        )

    def _delta(
        self,
        star: Star,
        mark: dt.datetime | dt.date,
        last: LastRun,
        written: dict[StarTable, list[str]],
        run_ts: dt.datetime,
    ) -> tuple[DataFrame, list[str]]:
        """The star rows touched since the mark, and the dimensions among which there can be any. A
        stamp is the time of the run that wrote the row, so months and dimensions that no later run
        wrote cannot have been touched: they are not read for it."""
        after = mark if isinstance(mark, dt.datetime) else dt.datetime.combine(mark, dt.time())
        parts = {table: dict.fromkeys(written[table], run_ts) for table in STAR_TABLES}
        months = last.order_months | parts[ORDER]
        recent = {month: ts for month, ts in months.items() if ts > after}
        fresh = last.dimensions | parts[CRAFTSMAN] | parts[PRODUCT] | parts[CUSTOMER]
        tables = {"craftsman": CRAFTSMAN, "customer": CUSTOMER, "product": PRODUCT}
        among = [name for name, table in tables.items() if fresh.get(table.name, after) > after]
        orders = self.tables.read_months(ORDER.name, ORDER.schema, recent)
        return delta(star, mark, orders, among), among

    def _refresh_report(
        self,
        star: Star,
        affected: DataFrame,
        seen: dict[str, object],
        last: LastRun,
        written: Parts,
        run_ts: dt.datetime,
    ) -> tuple[list[str], int]:
        """Bring the affected customer months up to date, and write the months in which a row is
        new or differs. Returns those months and the greatest id in the report.

        Months of which an order was touched are measured anew, from the orders of those months
        alone. Where only the customer was touched, their new attributes go into the rows."""
        schema = self._report_schema()
        measured, described = months_seen(seen["measured"]), months_seen(seen["described"])
        rows = []
        if measured:
            rows.append(self._measured(star, affected, measured, last, written))
        if described:
            rows.append(self._described(star, affected, described, last))
        if not rows:
            return [], last.last_report_id
        fresh = self.tables.write("report_rows", reduce(DataFrame.unionByName, rows), run_ts)
        known = self._report_in(sorted({*measured, *described}), last)
        changes, found = self.tables.write_watched(
            "report_changes",
            changed_rows(fresh, known, REPORT_KEY, null_safe=True),
            run_ts,
            watch_of(month=month_part(F.col("report_month"))),
        )
        months = months_seen(found["months"])
        if not months:
            return [], last.last_report_id
        target = self._report_in(months, last)

        # Rows without a month are one group per customer: here NULL equals NULL.
        measures = [name for name in REPORT_COLUMNS if name not in REPORT_KEY]
        kept = overwrite(target, changes, REPORT_KEY, measures, null_safe=True)
        added = with_report_ids(
            unmatched(target, changes, REPORT_KEY, null_safe=True),
            last.last_report_id,
            self.wide_keys,
        )
        after = self.tables.write_months(
            REPORT, kept.unionByName(added), F.col("report_month"), run_ts, watch_of(key="id")
        )
        return months, max(after["high"], last.last_report_id)

    def _measured(
        self, star: Star, affected: DataFrame, months: list[str], last: LastRun, written: Parts
    ) -> DataFrame:
        """The rows of customer months computed from their orders."""
        orders = self._orders_in(months, last, written)
        history = replace(star, order=orders_in(orders, affected.where("measured")))
        return conform_report(report_rows(history, dealt_by_customer=True), self.wide_keys)

    def _described(
        self, star: Star, affected: DataFrame, months: list[str], last: LastRun
    ) -> DataFrame:
        """The rows of customer months with the attributes that their customers have now."""
        known = self._report_in(months, last).select(*REPORT_COLUMNS)
        wanted = affected.where("not measured").select(
            F.col("customer_id").alias("__customer"), F.col("report_month").alias("__month")
        )
        same = (F.col("customer_id") == F.col("__customer")) & F.col("report_month").eqNullSafe(
            F.col("__month")
        )
        rows = known.join(wanted, same, "left_semi")
        return overwrite(rows, star.customer, ["customer_id"], CUSTOMER_ATTRIBUTES)

    def _orders_in(self, months: list[str], last: LastRun, written: Parts) -> DataFrame:
        """The orders of some months, as this run leaves them."""
        return self.tables.read_months(
            ORDER.name, ORDER.schema, _only(last.order_months | written, months)
        )

    def _report_in(self, months: list[str], last: LastRun) -> DataFrame:
        """The report's rows of some months, as the last run left them."""
        return self.tables.read_months(
            REPORT, self._report_schema(), _only(last.report_months, months)
        )

    def _report_schema(self) -> T.StructType:
        return widened(CUSTOMER_REPORT, "id", "customer_id") if self.wide_keys else CUSTOMER_REPORT


def _order_month() -> Column:
    return report_month(F.col("order_created_date"))


def _month_of(table: StarTable) -> Column | None:
    """The months that are watched: those of orders, as other tables have none."""
    return month_part(_order_month()) if table is ORDER else None


def _only(known: Parts, months: list[str]) -> Parts:
    return {month: known[month] for month in months if month in known}


def _time(ts: dt.datetime | None) -> Column:
    return F.lit(None).cast("timestamp_ntz") if ts is None else moment(ts)


def _names(parts: list[str]) -> Column:
    return F.array(*[F.lit(part) for part in parts]).cast("array<string>")
