"""Orders made in place are the orders, whatever shares a day or repeats."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import star
from tallyhouse.operators.checks import with_alike
from tallyhouse.plans.star_load import ORDER, source_rows
from tallyhouse.sources.marketplace import _AT_HAND, Marketplace, _is
from tallyhouse.sources.schemas import F_ORDER
from tallyhouse.sources.snapshots import SnapshotTables

ORDERS = [
    # Alone on its day; two of one customer and day; a repeated row; one key of two customers.
    (1, 10, "F", 1), (2, 10, "O", 2), (3, 10, "P", 2), (4, 11, "P", 3), (4, 11, "P", 3),
    (5, 12, "F", 4), (5, 13, "O", 5), (6, None, "F", 6), (7, None, "P", 6), (8, None, "O", 7),
    (9, 14, "F", None), (10, 14, "O", None), (None, 15, "F", 8), (11, 10, None, 9),
]
LINES = [
    (1, 100, 200, "F", 3), (1, 100, 200, "O", 9), (1, 101, 200, "F", 4), (1, 165, 200, "F", 4),
    (2, 100, 200, "O", 5), (3, 100, 200, "F", 6), (3, 101, 201, "O", 7), (2, 102, 201, "O", 7),
    (4, 100, 200, "F", 5), (4, 102, 200, "F", 5), (4, 102, 200, "F", 5), (5, 100, 200, "F", 8),
    (5, 103, 201, "O", 8), (6, 100, 200, "F", 9), (7, 100, 200, "O", 9), (7, 101, 200, None, 9),
    (8, None, 200, "O", 9), (8, 100, None, "O", None), (9, 100, 200, "F", 9),
    (10, 100, 200, "O", 9), (None, 100, 200, "O", 9), (11, 100, 200, "O", 9), (99, 1, 2, "F", 1),
]


@pytest.fixture(scope="module")
def market(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("market")

    def day(n):
        return None if n is None else dt.datetime(2001, 1, n, 5)

    spark.createDataFrame(
        [(key, customer, status, day(n)) for key, customer, status, n in ORDERS],
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_orderdate TIMESTAMP_NTZ",
    ).write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(
        [(*line[:4], day(line[4])) for line in LINES],
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linestatus STRING, "
        "l_shipdate TIMESTAMP_NTZ",
    ).write.parquet(f"{folder}/lineitem.parquet")
    return Marketplace(spark, str(folder))


@pytest.fixture
def settings(spark):
    changed = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_orders_made_in_place_are_the_orders(market):
    plain, made = market._orders(), market._orders_in_place()
    found = sorted(made.select(*plain.columns).collect(), key=str)
    assert found == sorted(plain.collect(), key=str)
    assert len(found) > 15


def test_lines_are_shuffled_once_for_orders_made_in_place(market, settings):
    plan = plan_of(market._orders_in_place())
    lines = [s for s in plan.splitlines() if "hashpartitioning(l_orderkey" in s]
    assert sum("ReusedExchange" not in s for s in lines) == 1
    assert plan.count("ReusedExchange") == 2
    # The rest goes by its key, and then by its first order: both of the second branch.
    assert plan.count("hashpartitioning(l_partkey") == 1
    assert plan.count("hashpartitioning(first_order") == 1


def test_deliveries_look_customers_up_for_the_source_orders(market, spark, settings, tmp_path):
    """The same orders with the same numbers, whatever the customers: repeated, of both kinds,
    unknown or without a nation."""
    folder = market._directory
    tables = {
        "region": ([(0, "ASIA"), (1, "EUROPE"), (2, None)], "r_regionkey INT, r_name STRING"),
        "nation": (
            [(0, "A", 0), (1, "B", 1), (2, "C", 2), (3, "D", None)],
            "n_nationkey INT, n_name STRING, n_regionkey INT",
        ),
        "customer": (
            [(10, "a", 0, "X"), (11, "b", 1, "X"), (11, "b", 0, "X"), (12, "c", 1, "BUILDING"),
             (12, "c", 1, "BUILDING"), (13, "d", 2, "X"), (14, "e", 3, "X"), (None, "g", 1, "X")],
            "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_mktsegment STRING",
        ),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    made = market._orders_to_deliver()
    plain = market._orders().where("product_id is not null and craftsman_id is not null")
    found = sorted(made.select(*plain.columns).collect(), key=str)
    assert found == sorted(plain.collect(), key=str) and len(found) > 10
    kinds = {(r.customer_id, r.kind) for r in made.collect()}
    assert kinds == {(10, 2), (11, 3), (12, 1), (13, 0), (14, 0), (None, 0)}
    # Deliveries cut the orders where they are made: only customers are shuffled for it.
    plan = plan_of(made.where(_is(_AT_HAND)))
    assert sum("hashpartitioning(customer_id" in s for s in plan.splitlines()) == 1
    lines = [s for s in plan.splitlines() if "hashpartitioning(l_orderkey" in s]
    assert sum("ReusedExchange" not in s for s in lines) == 1


def test_orders_dealt_by_key_are_counted_without_another_shuffle(spark, settings):
    names = star._ORDER
    orders = spark.createDataFrame(
        [(1, 5, 6, 7, None, None, "done")] * 3 + [(2, 5, 6, 7, None, None, "done")],
        ", ".join(f"{n} {'STRING' if n.endswith('status') else 'BIGINT'}" for n in names),
    )
    rows = with_alike(source_rows(ORDER, orders, orders, dealt_by_key=True), ORDER.natural_key)
    assert plan_of(rows).count("Exchange hashpartitioning") == 1
    assert sorted(r.order_id for r in rows.collect()) == [1, 2]


def test_a_table_that_is_not_there_takes_no_join(spark, settings, tmp_path):
    none = SnapshotTables(spark, str(tmp_path)).read_months(ORDER.name, F_ORDER, {})
    rows = spark.range(5).withColumnRenamed("id", "order_id")
    plan = plan_of(rows.join(none.select("order_id", F.lit(1).alias("hit")), "order_id", "left"))
    assert "Join" not in plan
