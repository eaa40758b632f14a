"""All forms of the report against a plain Python computation, with awkward rows."""

import datetime as dt
import random
from collections import Counter, defaultdict
from statistics import median

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.star import Star, orphan_orders, star_join
from tallyhouse.plans import report
from tallyhouse.plans.refresh import Refresh
from tallyhouse.sources import schemas
from tallyhouse.sources.schemas import REPORT_COLUMNS
from tallyhouse.sources.snapshots import SnapshotTables

D = dt.date
STATUSES = ["created", "in progress", "delivery", "done", "returned", None]


def make_star(spark, seed=7, orders=3000, hot=1):
    """Random orders, a third of them by one customer; some lack a dimension row, a month,
    a price or a completion, and some were completed before they were created."""
    rng = random.Random(seed)
    craftsmen = [(i, f"craftsman {i % 7}", "a", D(1980, 1, 1), f"m{i}", None) for i in range(10)]
    products = [
        (i, f"product {i % 11}", "d", "t", None if i == 5 else 10 * i + 3, None)
        for i in range(15)
    ]
    customers = [
        (i, None if i == 3 else f"customer {i}", "a", D(1990, 1, 1), f"c{i}", None)
        for i in range(12)
    ]
    rows = []
    for order_id in range(orders):
        created = D(2023, rng.randint(1, 3), rng.randint(1, 28))
        if rng.random() < 0.03:
            created = None
        completed = None
        if rng.random() < 0.7:
            completed = D(2023, 2, 14) + dt.timedelta(days=rng.randint(-40, 40))
        customer = hot if rng.random() < 0.34 else rng.randint(0, 13)
        rows.append(
            (
                order_id,
                None if customer == 13 else customer,
                rng.randint(0, 15),
                rng.randint(0, 10),
                created,
                completed,
                rng.choice(STATUSES),
                None,
            )
        )
    return Star(
        craftsman=spark.createDataFrame(craftsmen, schemas.D_CRAFTSMAN),
        product=spark.createDataFrame(products, schemas.D_PRODUCT),
        customer=spark.createDataFrame(customers, schemas.D_CUSTOMER),
        order=spark.createDataFrame(rows, schemas.F_ORDER),
    )


def by_hand(star):
    craftsmen = {r.craftsman_id: r for r in star.craftsman.collect()}
    products = {r.product_id: r for r in star.product.collect()}
    customers = {r.customer_id: r for r in star.customer.collect()}
    groups = defaultdict(list)
    for o in star.order.collect():
        if (
            o.order_craftsman_id in craftsmen
            and o.order_product_id in products
            and o.order_customer_id in customers
        ):
            month = o.order_created_date and o.order_created_date.strftime("%Y-%m")
            groups[o.order_customer_id, month].append(o)
    result = {}
    for (customer_id, month), orders in groups.items():
        prices = [products[o.order_product_id].product_price for o in orders]
        prices = [p for p in prices if p is not None]
        days = [
            abs((o.order_completion_date - o.order_created_date).days)
            for o in orders
            if o.order_completion_date and o.order_created_date
        ]
        statuses = Counter(o.order_status for o in orders)

        def most_frequent(names):
            counts = Counter(names)
            return month and min(counts, key=lambda name: (-counts[name], name))

        who = customers[customer_id]
        result[customer_id, month] = (
            customer_id,
            who.customer_name,
            who.customer_address,
            who.customer_birthday,
            who.customer_email,
            round(sum(prices) * 0.9, 1) if prices else None,
            round(sum(prices) * 0.1, 1) if prices else None,
            len(orders),
            round(sum(prices) / len(prices), 3) if prices else None,
            round(median(days)) if days else None,
            most_frequent([products[o.order_product_id].product_name for o in orders]),
            most_frequent([craftsmen[o.order_craftsman_id].craftsman_name for o in orders]),
            statuses["created"],
            statuses["in progress"],
            statuses["delivery"],
            statuses["done"],
            len(orders) - statuses["done"] - statuses[None],
            month,
        )
    return result


def collected(rows):
    found = {}
    for r in report.conform_report(rows).collect():
        values = list(r)
        for i, digits in ((5, 1), (6, 1), (8, 3)):
            values[i] = None if values[i] is None else round(values[i], digits)
        key = (r.customer_id, r.report_month)
        assert key not in found
        found[key] = tuple(values)
    return found


@pytest.fixture(scope="module")
def star(spark):
    return make_star(spark)


@pytest.fixture(scope="module")
def expected(star):
    return by_hand(star)


def test_folded(star, expected):
    assert collected(report.report_rows(star)) == expected


def test_a_missing_name_counts_as_a_name(spark, star):
    """Two orders of nameless products and one of another: the most popular one has no name."""
    nameless = star.product.withColumn(
        "product_name", F.when(F.col("product_id") > 1, F.col("product_name"))
    )
    changed = Star(star.craftsman, nameless, star.customer, star.order)
    rows = collected(report.report_rows(changed))
    assert rows == collected(report.ranked_report_rows(changed))
    assert any(row[10] is None for (_, month), row in rows.items() if month)


def test_a_hot_customer_month(spark, star):
    """All orders of one customer in one month, over many files."""
    hot = star.order.withColumns(
        {"order_customer_id": F.lit(1).cast("long"), "order_created_date": F.lit(D(2023, 1, 5))}
    ).repartition(40)
    changed = Star(star.craftsman, star.product, star.customer, hot)
    rows = collected(report.report_rows(changed))
    assert len(rows) == 1 and rows == collected(report.ranked_report_rows(changed))
    assert rows == by_hand(changed)


def test_no_job_runs_while_the_report_is_built(spark, star):
    spark.sparkContext.setJobGroup("building", "building")
    try:
        report.report_rows(star)
        report.ranked_report_rows(star)
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")


def test_ranked(star, expected):
    assert collected(report.ranked_report_rows(star)) == expected


def test_properties(star):
    rows = report.report_rows(star).collect()
    joined = star_join(star)
    assert sum(r.customer_order_count for r in rows) == joined.count()
    total = joined.agg(F.sum("product_price")).first()[0]
    assert sum(r.customer_paid + r.customer_earned for r in rows if r.customer_paid) == total
    for r in rows:
        open_orders = (
            r.number_of_orders_created_per_month
            + r.number_of_orders_in_progress_per_month
            + r.number_of_orders_in_delivery_per_month
        )
        assert open_orders <= r.number_of_orders_not_done_per_month
        known = r.number_of_orders_done_per_month + r.number_of_orders_not_done_per_month
        assert known <= r.customer_order_count


def test_orphans_are_what_the_star_join_leaves_out(star):
    orphans = {r.order_id for r in orphan_orders(star).collect()}
    joined = {r.order_id for r in star_join(star).collect()}
    assert orphans and not orphans & joined
    assert len(orphans) + len(joined) == star.order.count()


def test_the_order_of_input_does_not_matter(star):
    shuffled = Star(
        star.craftsman, star.product, star.customer, star.order.orderBy(F.rand(3))
    )
    assert collected(report.report_rows(shuffled)) == collected(report.report_rows(star))


def test_declared_types(star):
    rows = report.with_report_ids(report.conform_report(report.report_rows(star)))
    kinds = [(f.name, f.dataType) for f in rows.schema.fields]
    assert kinds == [(f.name, f.dataType) for f in schemas.CUSTOMER_REPORT.fields]
    assert [f.name for f in rows.schema.fields if f.name != "id"] == REPORT_COLUMNS


def test_a_customer_id_past_int_is_an_error_unless_wide(spark, star):
    far = 2**31 + 5
    moved = Star(
        star.craftsman,
        star.product,
        star.customer.withColumn("customer_id", F.col("customer_id") + far),
        star.order.withColumn("order_customer_id", F.col("order_customer_id") + far),
    )
    rows = report.report_rows(moved)
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        report.conform_report(rows).collect()
    wide = report.with_report_ids(report.conform_report(rows, wide_keys=True), wide_keys=True)
    assert wide.where(F.col("customer_id") < far).count() == 0


def test_half_days_round_to_even(spark):
    frame = spark.createDataFrame(
        [(0.5,), (1.5,), (2.5,), (3.5,), (None,)], "median_completion_time_per_month DOUBLE"
    )
    rounded = report.conform(frame, schemas.CUSTOMER_REPORT).collect()
    assert [r.median_completion_time_per_month for r in rounded] == [0, 2, 2, 4, None]
    assert all(r.id is None for r in rounded)


@pytest.mark.parametrize("seed", [7, 8])
def test_orders_dealt_by_customer_give_the_same_report_from_one_shuffle(spark, seed):
    star = make_star(spark, seed)
    dealt = report.report_rows(star, dealt_by_customer=True)
    found = sorted(dealt.collect(), key=str)
    assert found == sorted(report.report_rows(star).collect(), key=str) and len(found) > 30
    plan = dealt._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("hashpartitioning(customer_id") == 1 + plan.count("SortMergeJoin [customer_id")
    assert not any("hashpartitioning(customer_id" in s and "month" in s for s in plan.splitlines())


@pytest.mark.parametrize("exact", [False, True])
def test_the_refresh_deals_orders_by_customer(spark, tmp_path, monkeypatch, exact):
    """It folds them where they meet: no state of a customer month is shuffled."""
    plans, write = [], SnapshotTables.write

    def noted(self, name, rows, run_ts):
        if name == "report_rows":
            plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return write(self, name, rows, run_ts)

    monkeypatch.setattr(SnapshotTables, "write", noted)
    star = make_star(spark, orders=40)
    orders = (
        star.order.where("order_created_date is not null")
        .withColumnsRenamed({f"order_{n}_id": f"{n}_id" for n in ("product", "craftsman", "customer")})
        .drop("load_dttm")
        .join(star.product.where("product_price is not null").drop("load_dttm"), "product_id")
        .join(star.craftsman.drop("load_dttm"), "craftsman_id")
        .dropDuplicates(["product_id", "craftsman_id", "customer_id", "order_created_date"])
        .withColumn("load_dttm", F.lit(dt.datetime(2024, 1, 1)))
    )
    customers = star.customer.where("customer_name is not null").drop("load_dttm")
    Refresh(spark, str(tmp_path), exact_mark=exact, only_if_changed=exact).run(
        orders.where("customer_id is not null and order_status is not null"),
        customers,
        dt.datetime(2024, 1, 2),
    )
    assert len(plans) == 1
    lines = plans[0].splitlines()
    assert not any("partial_percentile" in after for s, after in zip(lines, lines[1:]) if "Exchange" in s)
