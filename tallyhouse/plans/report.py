"""The customer x month report.

`report_rows` is the plan to use: one aggregation by customer and month. `ranked_report_rows`
computes the same from an aggregate and two rankings over the same tally of equal orders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import columns as c
from tallyhouse.operators.conform import conform
from tallyhouse.operators.ids import with_row_ids
from tallyhouse.operators.ranking import top1
from tallyhouse.operators.star import Star
from tallyhouse.sources.schemas import CUSTOMER_REPORT, REPORT_COLUMNS, widened

_GROUP = ["customer_id", "month"]
_NAMES = ["product_name", "craftsman_name"]
_MOST_POPULAR = ["customer_most_popular_product_per_month", "customer_most_popular_craftsman"]
# Put before a name that is there, so that a missing name is counted like any other.
_KNOWN = "+"


def order_lines(star: Star) -> DataFrame:
    """What the report needs of each order: nothing else goes through its shuffles.

    Customers are joined after the aggregation: their attributes depend on the key alone,
    and there are far fewer customer months than orders. An order without a customer
    would only be left out then, so it is not carried along."""
    return (
        star.order.where(F.col("order_customer_id").isNotNull())
        .join(
            star.product.select("product_id", "product_name", "product_price"),
            F.col("order_product_id") == F.col("product_id"),
        )
        .join(
            star.craftsman.select("craftsman_id", "craftsman_name"),
            F.col("order_craftsman_id") == F.col("craftsman_id"),
        )
        .select(
            F.col("order_customer_id").alias("customer_id"),
            c.month_start(F.col("order_created_date")).alias("month"),
            "product_name",
            "craftsman_name",
            "product_price",
            "order_status",
            c.completion_days(
                F.col("order_completion_date"), F.col("order_created_date")
            ).alias("days"),
        )
    )


def report_rows(star: Star, dealt_by_customer: bool = False) -> DataFrame:
    """The report without ids, by one plan for groups of every size.

    `dealt_by_customer` shuffles the orders by customer instead of states by customer and month.
    Where most orders meet no other of their customer month in the task that reads them, states
    are longer than orders; and what is dealt by customer needs no other shuffle to be described.
    All orders of a customer are then one task's work, sorted on disk if need be."""
    lines = order_lines(star)
    if dealt_by_customer:
        lines = lines.repartition("customer_id")
    return _described(_known_months(fold(lines)), star.customer)


def _known_months(rows: DataFrame) -> DataFrame:
    """A month that is not known has no most popular product or craftsman."""
    known = F.col("month").isNotNull()
    return rows.withColumns({name: F.when(known, F.col(name)) for name in _MOST_POPULAR})


def fold(lines: DataFrame) -> DataFrame:
    """All measures per customer and month, from one shuffle by them.

    Every task that reads orders combines its own, so the orders of a customer month with a
    large share of them are folded where they are read, by as many tasks as read them, and one
    state per task and group is shuffled. The states hold a count per different name and
    number of days: what meets in one task grows with the different names of a group, not
    with its orders."""
    return lines.groupBy(*_GROUP).agg(
        *_line_measures(),
        *[
            _mode(name).alias(most_popular)
            for name, most_popular in zip(_NAMES, _MOST_POPULAR)
        ],
    )


def _mode(name: str) -> Column:
    """The most frequent name; ties go to the smaller one. A missing name counts as a name,
    before all others, where Spark's mode would leave it out."""
    told = F.coalesce(F.concat(F.lit(_KNOWN), F.col(name)), F.lit(""))
    found = F.mode(told, deterministic=True)
    return F.when(found != "", F.substr(found, F.lit(len(_KNOWN) + 1)))


def ranked_report_rows(star: Star) -> DataFrame:
    """The report without ids, from one aggregate and two rankings joined to it.

    All three start from the tally of equal orders. Its rows are spread by all of their
    columns, which no branch can leave out, so Spark makes them once for the three."""
    tally = tallied(order_lines(star))
    rows = tallied_measures(tally)
    for name, most_popular in zip(_NAMES, _MOST_POPULAR):
        top = top1(tally, _GROUP, name, most_popular, "orders").withColumnsRenamed(
            {"customer_id": "__customer", "month": "__month"}
        )
        # A null-safe match adds no condition on the month to one side's tally only.
        same = (F.col("customer_id") == F.col("__customer")) & F.col("month").eqNullSafe(
            F.col("__month")
        )
        rows = rows.join(top, same, "left").drop("__customer", "__month")
    return _described(_known_months(rows), star.customer)


def tallied(lines: DataFrame) -> DataFrame:
    """The different orders of each customer month, and how many there are of each."""
    return lines.groupBy(*lines.columns).agg(F.count(F.lit(1)).alias("orders"))


def tallied_measures(tally: DataFrame) -> DataFrame:
    """Money, counts and median per customer and month of tallied orders."""
    orders = F.col("orders")
    priced = F.when(F.col("product_price").isNotNull(), orders).otherwise(0)
    return tally.groupBy(*_GROUP).agg(
        *_measures(
            total=F.sum(F.col("product_price").cast("long") * orders),
            priced=F.sum(priced),
            orders=F.sum(orders),
            median=F.percentile("days", 0.5, orders),
            statuses=c.status_counts(F.col("order_status"), orders),
        )
    )


def monthly_measures(lines: DataFrame) -> DataFrame:
    """Money, counts and median per customer and month. All of them are combined before
    the shuffle; the median's state is a count per number of days."""
    return lines.groupBy(*_GROUP).agg(*_line_measures())


def top_products(lines: DataFrame) -> DataFrame:
    return top1(lines, _GROUP, _NAMES[0], _MOST_POPULAR[0])


def top_craftsmen(lines: DataFrame) -> DataFrame:
    return top1(lines, _GROUP, _NAMES[1], _MOST_POPULAR[1])


def with_month_text(rows: DataFrame) -> DataFrame:
    """The month as the text that the report shows."""
    return rows.withColumn("report_month", c.report_month(F.col("month"))).drop("month")


def conform_report(rows: DataFrame, wide_keys: bool = False) -> DataFrame:
    """The rows in the report's declared types. `wide_keys` keeps customer ids, and the
    row ids where there are any, as BIGINT."""
    schema = widened(CUSTOMER_REPORT, "id", "customer_id") if wide_keys else CUSTOMER_REPORT
    conformed = conform(rows, schema)
    return conformed if "id" in rows.columns else conformed.select(*REPORT_COLUMNS)


def with_report_ids(rows: DataFrame, after: int = 0, wide_keys: bool = False) -> DataFrame:
    """Report rows with ids that continue after the given one."""
    return conform_report(
        with_row_ids(rows, "customer_id", ["report_month"], after=after), wide_keys
    )


def _line_measures() -> list[Column]:
    return _measures(
        total=F.sum("product_price"),
        priced=F.count("product_price"),
        orders=F.count(F.lit(1)),
        median=F.percentile("days", 0.5),
        statuses=c.status_counts(F.col("order_status")),
    )


def _measures(
    total: Column, priced: Column, orders: Column, median: Column, statuses: dict[str, Column]
) -> list[Column]:
    # The order id is never NULL, so counting orders is counting rows, and the scan can
    # leave the id out.
    return [
        c.paid(total).alias("customer_paid"),
        c.earned(total).alias("customer_earned"),
        orders.alias("customer_order_count"),
        c.mean(total, priced).alias("customer_avg_price_per_month"),
        median.alias("median_completion_time_per_month"),
        *[count.alias(name) for name, count in statuses.items()],
    ]


def _described(rows: DataFrame, customers: DataFrame) -> DataFrame:
    """Add the customer's attributes; rows of unknown customers are left out."""
    attributes = customers.drop("load_dttm")
    return with_month_text(rows.join(attributes, "customer_id")).select(*REPORT_COLUMNS)
