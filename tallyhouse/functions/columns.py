"""Column expressions shared by the report plans. All are built-in Spark expressions."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the report.
MONTH_FORMAT = "yyyy-MM"
PLATFORM_SHARE = Decimal("0.1")
STATUS_CREATED = "created"
STATUS_IN_PROGRESS = "in progress"
STATUS_DELIVERY = "delivery"
STATUS_DONE = "done"


def report_month(date: Column) -> Column:
    """Year and month as text. `yyyy-MM`: in Spark `mm` means minutes."""
    return F.date_format(date, MONTH_FORMAT)


def month_start(date: Column) -> Column:
    """The month as a 4-byte date: cheaper to group and shuffle by than its text."""
    return F.trunc(date, "month")


def completion_days(completed: Column, created: Column) -> Column:
    """Days between two dates, either way round; NULL while the order is open."""
    return F.abs(F.date_diff(completed.cast("date"), created.cast("date")))


def paid(total: Column) -> Column:
    """What is left of a sum of prices after the platform's share."""
    return total - total * F.lit(PLATFORM_SHARE)


def earned(total: Column) -> Column:
    """The platform's share of a sum of prices."""
    return total * F.lit(PLATFORM_SHARE)


def mean(total: Column, count: Column) -> Column:
    """Average from an exact sum and count; NULL when nothing was counted."""
    return F.when(count > 0, total.cast("double") / count)


def whole_days(days: Column) -> Column:
    """Round half to even before narrowing: a plain cast would truncate 3.5 to 3."""
    return F.rint(days).cast("int")


def count_where(condition: Column) -> Column:
    """How many rows meet the condition; NULL conditions count as not met."""
    return F.sum(F.when(condition, 1).otherwise(0))


def status_counts(status: Column, weight: Column | None = None) -> dict[str, Column]:
    """The five order counts by status. A NULL status is counted in none of them."""
    conditions = {
        "number_of_orders_created_per_month": status == STATUS_CREATED,
        "number_of_orders_in_progress_per_month": status == STATUS_IN_PROGRESS,
        "number_of_orders_in_delivery_per_month": status == STATUS_DELIVERY,
        "number_of_orders_done_per_month": status == STATUS_DONE,
        "number_of_orders_not_done_per_month": status != STATUS_DONE,
    }
    if weight is None:
        return {name: count_where(met) for name, met in conditions.items()}
    return {
        name: F.sum(F.when(met, weight).otherwise(0)) for name, met in conditions.items()
    }


def moment(ts: dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal. It goes through text, because a Python datetime would be
    read in the machine's time zone."""
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")
