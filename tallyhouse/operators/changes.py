"""Change capture by high-water mark: what was touched, whom it affects, the next mark."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.columns import moment, report_month
from tallyhouse.operators.key_filter import key_filter, may_hold
from tallyhouse.operators.star import Star, star_join

# Fixed value: the mark before the first run.
FIRST_MARK = dt.date(1900, 1, 1)

DIMENSION_STAMPS = ["craftsman_load_dttm", "customers_load_dttm", "products_load_dttm"]
CUSTOMER_STAMP, ORDER_STAMP = "customers_load_dttm", "order_load_dttm"
MONTH_KEY = ["customer_id", "report_month"]


def hwm_read(log: DataFrame) -> DataFrame:
    """One row with the greatest mark of the log, also when the log is empty."""
    return log.agg(latest_mark("load_dttm", "date"))


def latest_mark(column: str, kind: str) -> Column:
    """The greatest mark in a column of the log; the first mark when there is none."""
    return F.coalesce(F.max(column), F.lit(FIRST_MARK).cast(kind)).alias(column)


def hwm_next(delta: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """One row with the mark to append after a run, as a day."""
    return delta.agg(day_mark(run_ts).alias("load_dttm"))


def day_mark(run_ts: dt.datetime) -> Column:
    """The latest dimension stamp of the delta, cut to its day. A stamp column without
    values counts as the time of the run."""
    latest = [F.coalesce(F.max(c), moment(run_ts)) for c in DIMENSION_STAMPS]
    return F.greatest(*latest).cast("date")


def exact_mark(mark: dt.datetime | dt.date) -> Column:
    """The latest stamp of the delta, orders included, at full precision. An empty delta
    leaves the mark where it is."""
    latest = F.greatest(*[F.max(c) for c in [*DIMENSION_STAMPS, ORDER_STAMP]])
    return F.coalesce(latest, _bound(mark)).cast("timestamp_ntz")


def touched(table: DataFrame, mark: dt.datetime | dt.date) -> DataFrame:
    """Rows stamped after the mark. A row that was never stamped is not touched."""
    return table.where(F.col("load_dttm") > _bound(mark))


DIMENSIONS = ("craftsman", "customer", "product")


def delta(
    star: Star,
    mark: dt.datetime | dt.date,
    recent: DataFrame | None = None,
    among: Sequence[str] = DIMENSIONS,
) -> DataFrame:
    """Star rows of which the order or one of its dimensions was stamped after the mark."""
    reached = touched_orders(star, mark, recent, among)
    return star_join(Star(star.craftsman, star.product, star.customer, reached))


def touched_orders(
    star: Star,
    mark: dt.datetime | dt.date,
    recent: DataFrame | None = None,
    among: Sequence[str] = DIMENSIONS,
) -> DataFrame:
    """Orders that were stamped after the mark, or whose dimensions were.

    The first are a filter on the stamp alone, which reaches the scan; `recent` may be the part
    of the orders that can have such stamps. The others are found by the keys touched in the
    dimensions `among` which there can be any, few in a regular run. A filter over these keys cuts
    the orders where they are read, so that the joins shuffle little else than what they keep."""
    stamped = F.col("load_dttm") > _bound(mark)
    out = (star.order if recent is None else recent).where(stamped)
    if not among:
        return out
    keys = {}
    for name in among:
        key = F.col(f"{name}_id").alias(f"order_{name}_id")
        keys[name] = touched(getattr(star, name), mark).select(key)
    near = [may_hold(key_filter(of), F.col(f"order_{name}_id")) for name, of in keys.items()]
    rest = star.order.where(~F.coalesce(stamped, F.lit(False))).where(reduce(or_, near))
    for name, of in keys.items():
        rest = rest.join(of.withColumn(f"__{name}", F.lit(True)), f"order_{name}_id", "left")
    reached = F.coalesce(*[F.col(f"__{name}") for name in among])
    return out.unionByName(rest.where(reached).select(*star.order.columns))


def flag_known(delta_rows: DataFrame, report: DataFrame) -> DataFrame:
    """The delta rows, and the id of those of their customers that the report already has. The
    report has a row per month, so its customers are made distinct first: no delta row is
    repeated."""
    known = report.select(F.col("customer_id").cast("bigint")).distinct()
    return delta_rows.join(
        known.withColumn("exist_customer_id", F.col("customer_id")), "customer_id", "left"
    )


def new_customers(delta_rows: DataFrame, report: DataFrame) -> DataFrame:
    """Customers of the delta that the report does not have yet."""
    known = report.select(F.col("customer_id").cast("bigint"))
    return affected_customers(delta_rows).join(known, "customer_id", "left_anti")


def affected_customers(delta_rows: DataFrame) -> DataFrame:
    """Customers whose report rows must be computed again."""
    return delta_rows.select("customer_id").where(F.col("customer_id").isNotNull()).distinct()


def affected_months(delta_rows: DataFrame) -> DataFrame:
    """Customer months of which an order was touched: the rows of the report that can differ."""
    return delta_rows.select(*MONTH_KEY).where(F.col("customer_id").isNotNull()).distinct()


def affected_summary(delta_rows: DataFrame, mark: dt.datetime | dt.date) -> DataFrame:
    """The affected customer months with the number and the latest stamps of their delta rows:
    both the keys to bring up to date and all that the next mark needs, from one pass.

    A month is `measured` anew when an order, a craftsman or a product of it was touched. If only
    the customer was, none of its measures can differ."""
    stamps = [c for c in [*DIMENSION_STAMPS, ORDER_STAMP] if c != CUSTOMER_STAMP]
    measured = reduce(or_, [F.coalesce(F.col(c) > _bound(mark), F.lit(False)) for c in stamps])
    return delta_rows.groupBy(*MONTH_KEY).agg(
        F.count(F.lit(1)).alias("delta_rows"),
        F.bool_or(measured).alias("measured"),
        *[F.max(c).alias(c) for c in [*DIMENSION_STAMPS, ORDER_STAMP]],
    )


def measured_if_unknown(summary: DataFrame, report: DataFrame) -> DataFrame:
    """The summary, in which months that the report does not have yet are measured too: those of a
    customer who appeared after their orders."""
    known = report.select(
        F.col("customer_id").cast("bigint").alias("__customer"),
        F.col("report_month").alias("__month"),
        F.lit(True).alias("__known"),
    )
    same = (F.col("customer_id") == F.col("__customer")) & F.col("report_month").eqNullSafe(
        F.col("__month")
    )
    measured = F.col("measured") | F.col("__known").isNull()
    return (
        summary.join(known, same, "left")
        .withColumn("measured", measured)
        .select(*summary.columns)
    )


def orders_in(orders: DataFrame, months: DataFrame) -> DataFrame:
    """The orders of the given customer months. Orders without a day are a month of their own."""
    wanted = months.select(
        F.col("customer_id").alias("__customer"), F.col("report_month").alias("__month")
    )
    same = (F.col("order_customer_id") == F.col("__customer")) & report_month(
        F.col("order_created_date")
    ).eqNullSafe(F.col("__month"))
    return orders.join(wanted, same, "left_semi")


def orders_of(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """The whole history of the given customers."""
    return orders.join(
        customers.select(F.col("customer_id").alias("order_customer_id")),
        "order_customer_id",
        "left_semi",
    ).select(*orders.columns)


def _bound(mark: dt.datetime | dt.date) -> Column:
    return moment(mark) if isinstance(mark, dt.datetime) else F.lit(mark)
