"""Eight orders in two deliveries, worked out by hand."""

import datetime as dt

import pytest

from tallyhouse.plans.refresh import Refresh
from tallyhouse.plans.report import conform_report, ranked_report_rows, report_rows
from tallyhouse.sources import schemas

D = dt.date
FIRST, SECOND, THIRD = (dt.datetime(2023, 3, day, 12) for day in (1, 2, 3))

CRAFTSMEN = {"Ann": 1, "Bob": 2}
PRODUCTS = {"Mug": (1, 100), "Vase": (2, 55), "Rug": (3, 33)}

BATCH_1 = [
    (1, 1, "Mug", "Ann", D(2023, 1, 5), D(2023, 1, 8), "done"),
    (2, 1, "Mug", "Bob", D(2023, 1, 10), D(2023, 1, 14), "done"),
    (3, 1, "Vase", "Bob", D(2023, 1, 20), None, "in progress"),
    (4, 1, "Vase", "Ann", D(2023, 2, 1), D(2023, 2, 2), "delivery"),
    (5, 2, "Rug", "Ann", D(2023, 1, 15), None, "created"),
    (6, 2, "Mug", "Ann", D(2023, 1, 16), D(2023, 1, 10), None),
]
BATCH_2 = [
    (3, 1, "Vase", "Bob", D(2023, 1, 20), D(2023, 1, 25), "done"),
    (7, 2, "Rug", "Bob", D(2023, 2, 3), None, "created"),
    (8, 3, "Vase", "Bob", D(2023, 2, 10), D(2023, 2, 12), "done"),
]

AFTER_1 = [
    (1, "2023-01", 229.5, 25.5, 3, 85.0, 4, 0, 1, 0, 2, 1, "Mug", "Bob"),
    (1, "2023-02", 49.5, 5.5, 1, 55.0, 1, 0, 0, 1, 0, 1, "Vase", "Ann"),
    (2, "2023-01", 119.7, 13.3, 2, 66.5, 6, 1, 0, 0, 0, 1, "Mug", "Ann"),
]
AFTER_2 = [
    (1, "2023-01", 229.5, 25.5, 3, 85.0, 4, 0, 0, 0, 3, 0, "Mug", "Bob"),
    (1, "2023-02", 49.5, 5.5, 1, 55.0, 1, 0, 0, 1, 0, 1, "Vase", "Ann"),
    (2, "2023-01", 119.7, 13.3, 2, 66.5, 6, 1, 0, 0, 0, 1, "Mug", "Ann"),
    (2, "2023-02", 29.7, 3.3, 1, 33.0, None, 1, 0, 0, 0, 1, "Rug", "Bob"),
    (3, "2023-02", 49.5, 5.5, 1, 55.0, 2, 0, 0, 0, 1, 0, "Vase", "Bob"),
]

SHOWN = [
    "customer_id",
    "report_month",
    "customer_paid",
    "customer_earned",
    "customer_order_count",
    "customer_avg_price_per_month",
    "median_completion_time_per_month",
    "number_of_orders_created_per_month",
    "number_of_orders_in_progress_per_month",
    "number_of_orders_in_delivery_per_month",
    "number_of_orders_done_per_month",
    "number_of_orders_not_done_per_month",
    "customer_most_popular_product_per_month",
    "customer_most_popular_craftsman",
]


def wide(spark, orders, loaded=FIRST):
    rows = []
    for order_id, customer, product, craftsman, created, completed, status in orders:
        product_id, price = PRODUCTS[product]
        rows.append(
            (
                CRAFTSMEN[craftsman], craftsman, f"{craftsman} Street", D(1980, 1, 1),
                f"{craftsman}@example.org", product_id, product, f"a {product}", "craft", price,
                order_id, customer, created, completed, status, loaded,
            )
        )
    return spark.createDataFrame(rows, schemas.CRAFT_PRODUCTS_ORDERS)


def customers(spark, *ids):
    return spark.createDataFrame(
        [(i, f"Customer {i}", f"Road {i}", D(1990, 1, i), f"c{i}@example.org") for i in ids],
        schemas.CUSTOMERS,
    )


def shown(report):
    rows = report.select(*SHOWN).orderBy("customer_id", "report_month").collect()
    return [tuple(round(v, 4) if isinstance(v, float) else v for v in row) for row in rows]


@pytest.mark.parametrize("exact", [False, True])
def test_two_deliveries(spark, tmp_path, exact):
    refresh = Refresh(spark, str(tmp_path), exact_mark=exact, only_if_changed=exact)
    first = refresh.run(wide(spark, BATCH_1), customers(spark, 1, 2), FIRST)
    assert shown(first) == AFTER_1
    second = refresh.run(wide(spark, BATCH_2), customers(spark, 3), SECOND)
    assert shown(second) == AFTER_2
    assert sorted(r.id for r in second.collect()) == [1, 2, 3, 4, 5]

    for form in (report_rows, ranked_report_rows):
        assert shown(conform_report(form(refresh.star()))) == AFTER_2


def test_repeating_a_delivery_changes_nothing(spark, tmp_path):
    refresh = Refresh(spark, str(tmp_path))
    refresh.run(wide(spark, BATCH_1), customers(spark, 1, 2), FIRST)
    before = sorted(refresh.run(wide(spark, BATCH_2), customers(spark, 3), SECOND).collect())
    again = refresh.run(wide(spark, BATCH_2), customers(spark, 3), THIRD)
    assert sorted(again.collect()) == before
    assert refresh.tables.log().count() == 3


def test_an_unfinished_run_is_not_seen(spark, tmp_path):
    refresh = Refresh(spark, str(tmp_path))
    refresh.run(wide(spark, BATCH_1), customers(spark, 1, 2), FIRST)
    refresh.merge_delivery(
        wide(spark, BATCH_2), customers(spark, 3), refresh.last_run(), SECOND
    )
    assert shown(refresh.report()) == AFTER_1
    assert shown(refresh.run(wide(spark, BATCH_2), customers(spark, 3), SECOND)) == AFTER_2


def test_a_run_must_be_later_than_the_last(spark, tmp_path):
    refresh = Refresh(spark, str(tmp_path))
    refresh.run(wide(spark, BATCH_1), customers(spark, 1, 2), SECOND)
    with pytest.raises(ValueError, match="not later"):
        refresh.run(wide(spark, BATCH_2), customers(spark, 3), FIRST)
