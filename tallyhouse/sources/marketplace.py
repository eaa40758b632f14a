"""The marketplace sources, mapped from TPC-H-like tables.

Suppliers are craftsmen, parts are products, customers are customers. Lines that share
(product, craftsman, customer, creation day) are one order, so that the star's natural
keys are unique. Its number is made of the smallest source order it has lines of and its rank
among the keys of that one, so no two keys can share a number, whatever the size, and a key has
the same number in every delivery.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.functions.columns import (
    STATUS_CREATED,
    STATUS_DELIVERY,
    STATUS_DONE,
    STATUS_IN_PROGRESS,
    moment,
)
from tallyhouse.operators.conform import conform
from tallyhouse.operators.star import Star
from tallyhouse.sources import schemas

# How the data is split into two deliveries: the first one lacks the customers of the
# region that opens later and the orders created from ORDERS_UNTIL on, still has the
# former addresses of one customer segment, and shows orders completed from
# COMPLETIONS_UNTIL on as being in progress.
LATE_REGION = "ASIA"
MOVED_SEGMENT = "BUILDING"
ORDERS_UNTIL = dt.date(2001, 6, 1)
COMPLETIONS_UNTIL = dt.date(2001, 10, 15)
CHANGED_TYPE = "PROMO"
CHANGED_SIZE = 50
FIRST_RUN = dt.datetime(2002, 1, 1, 12)
SECOND_RUN = dt.datetime(2002, 2, 1, 12)

_STATUSES = [STATUS_CREATED, STATUS_IN_PROGRESS, STATUS_DELIVERY, STATUS_DONE]
# The keys of one source order are ranked in so many parts, and each part has so many numbers.
_ORDER_PARTS, _ORDER_ROOM = 64, 1 << 14
# What a customer is to the deliveries.
_AT_HAND, _LATE = 1, 2
_NATURAL_KEY = ["product_id", "craftsman_id", "customer_id", "order_created_date"]


@dataclass(frozen=True)
class Delivery:
    """One delivery of the two source tables."""

    craft_products_orders: DataFrame
    customers: DataFrame


class Marketplace:
    """The given tables of one directory, seen as the marketplace sources."""

    def __init__(self, spark: SparkSession, directory: str):
        self._spark = spark
        self._directory = directory
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A given table. Its files are looked at once, however often it is used."""
        if name not in self._tables:
            path = f"{self._directory}/{name}.parquet"
            self._tables[name] = self._spark.read.parquet(path)
        return self._tables[name]

    def craftsmen(self) -> DataFrame:
        nation = self.table("nation").select("n_nationkey", "n_name")
        return (
            self.table("supplier")
            .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("s_suppkey").alias("craftsman_id"),
                F.col("s_name").alias("craftsman_name"),
                F.col("n_name").alias("craftsman_address"),
                _birthday("s_suppkey").alias("craftsman_birthday"),
                _email("s_name").alias("craftsman_email"),
            )
        )

    def products(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.concat(
                F.concat_ws(" ", "p_brand", "p_type", "p_size"),
                F.lit(" #"),
                F.col("p_partkey").cast("string"),
            ).alias("product_description"),
            F.col("p_type").alias("product_type"),
            F.round(F.col("p_retailprice") * 100).cast("int").alias("product_price"),
        )

    def customers(self) -> DataFrame:
        return self._customers().drop("region", "segment")

    def orders(self) -> DataFrame:
        return self._named(self._orders())

    def craft_products_orders(self, delivered_at: dt.datetime = FIRST_RUN) -> DataFrame:
        """The wide source: every order with its craftsman and its product."""
        return self._widen(self.orders(), delivered_at)

    def star(self, in_place: bool = False) -> Star:
        """The star tables as they are after all deliveries, without load stamps. Of orders made
        `in_place` only few lines are shuffled again by their key (see `_orders_in_place`), and none
        that lacks its product or craftsman is among them: the report leaves those out."""
        orders = self._named(self._orders_to_deliver()) if in_place else self.orders()
        return Star(
            craftsman=conform(self.craftsmen(), schemas.D_CRAFTSMAN),
            product=conform(self.products(), schemas.D_PRODUCT),
            customer=conform(self.customers(), schemas.D_CUSTOMER),
            order=conform(_as_fact(orders), schemas.F_ORDER),
        )

    def first_delivery(self) -> Delivery:
        at_hand = self._customers().where(F.col("region") != LATE_REGION)
        orders = self._orders_to_deliver().where(
            (F.col("order_created_date") < F.lit(ORDERS_UNTIL)) & _is(_AT_HAND)
        )
        pending = _completes_late()
        orders = orders.withColumns(
            {
                "status_rank": F.when(
                    pending, F.lit(_STATUSES.index(STATUS_IN_PROGRESS))
                ).otherwise(F.col("status_rank")),
                "order_completion_date": F.when(
                    ~F.coalesce(pending, F.lit(False)), F.col("order_completion_date")
                ),
            }
        )
        moved = F.col("segment") == MOVED_SEGMENT
        customers = at_hand.withColumn(
            "customer_address",
            F.when(moved, F.concat(F.lit("former "), "customer_address")).otherwise(
                F.col("customer_address")
            ),
        )
        return Delivery(
            self._widen(self._named(orders), FIRST_RUN), customers.drop("region", "segment")
        )

    def second_delivery(self) -> Delivery:
        customers = self._customers()
        orders = self._orders_to_deliver().where(
            _is(_LATE)
            | (F.col("order_created_date") >= F.lit(ORDERS_UNTIL))
            | _completes_late()
        )
        changed = customers.where(
            (F.col("region") == LATE_REGION) | (F.col("segment") == MOVED_SEGMENT)
        )
        return Delivery(
            self._widen(self._named(orders), SECOND_RUN), changed.drop("region", "segment")
        )

    def earlier_craftsmen(self) -> DataFrame:
        """Craftsmen before the late region opened, at their former addresses."""
        region = self.table("region").where(F.col("r_name") != LATE_REGION)
        nations = (
            self.table("nation")
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("n_name").alias("craftsman_address"))
        )
        return (
            self.craftsmen()
            .join(nations, "craftsman_address", "left_semi")
            .withColumn(
                "craftsman_address", F.concat(F.lit("former "), F.col("craftsman_address"))
            )
        )

    def earlier_products(self) -> DataFrame:
        """Products before the changed type was introduced, under their former types."""
        return (
            self.products()
            .where(F.col("product_type") != CHANGED_TYPE)
            .withColumn("product_type", F.concat(F.lit("former "), F.col("product_type")))
        )

    def stamped_star(self) -> Star:
        """The star with load stamps: orders came in at noon of the day they were created,
        moved customers with the second run, resized products with the first one, all
        craftsmen long ago; the other rows were never stamped."""
        star = self.star()
        orders = conform(_as_fact(self._named(self._orders_in_place())), schemas.F_ORDER)
        moved = self._customers().where(F.col("segment") == MOVED_SEGMENT)
        resized = (
            self.table("part")
            .where((F.col("p_type") == CHANGED_TYPE) & (F.col("p_size") == CHANGED_SIZE))
            .select(F.col("p_partkey").alias("product_id"))
        )
        return Star(
            craftsman=star.craftsman.withColumn("load_dttm", moment(dt.datetime(1999, 1, 1))),
            product=_stamped_where(star.product, resized, "product_id", FIRST_RUN),
            customer=_stamped_where(star.customer, moved, "customer_id", SECOND_RUN),
            order=orders.withColumn(
                "load_dttm",
                F.col("order_created_date").cast("timestamp_ntz") + F.expr("INTERVAL 12 HOURS"),
            ),
        )

    def _customers(self) -> DataFrame:
        nation = self.table("nation")
        region = self.table("region")
        return (
            self.table("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("c_custkey").alias("customer_id"),
                F.col("c_name").alias("customer_name"),
                F.col("n_name").alias("customer_address"),
                _birthday("c_custkey").alias("customer_birthday"),
                _email("c_name").alias("customer_email"),
                F.col("r_name").alias("region"),
                F.col("c_mktsegment").alias("segment"),
            )
        )

    def _orders(self) -> DataFrame:
        """One row per natural key: the furthest status and the latest completion of its
        lines. Only numbers and dates are aggregated, so the rows of one key are combined
        by hash before the shuffle. Keys of one first order share customer and day, and there
        are no more of them than that order has lines; more than a number has room for are an
        error."""
        heads = self.table("orders").withColumn("order_day", F.col("o_orderdate").cast("date"))
        lines = self.table("lineitem").join(heads, F.col("l_orderkey") == F.col("o_orderkey"))
        first = F.min("l_orderkey").alias("first_order")
        return _numbered(lines.groupBy(*_line_key()).agg(first, *_furthest()))

    def _orders_in_place(self) -> DataFrame:
        """The rows of `_orders`, for those who need the numbers too. Lines of one key share
        customer and day, so those of an order that is the only one of its customer and day are
        combined and numbered where they are joined to it. Only those of other orders are shuffled
        again, by their key. The lines are shuffled once for both, and sorted for each."""
        return _made_in_place(self.table("lineitem"), self._heads(), _furthest())

    def _orders_to_deliver(self) -> DataFrame:
        """The rows of `_orders_in_place` that have a product and a craftsman, and what their
        customer is to the deliveries (`_is`). Customers are looked up for the source orders, of
        which there are fewer, and shorter ones; an order's customer is that of its lines. Numbers
        are the same: what lacks a product or a craftsman has none."""
        region = F.col("region")
        customers = (
            self._customers()
            .groupBy(F.col("customer_id").alias("o_custkey"))
            .agg(
                F.max(F.when(region != LATE_REGION, _AT_HAND).otherwise(0)).alias("at_hand"),
                F.max(F.when(region == LATE_REGION, _LATE).otherwise(0)).alias("late"),
            )
            .select("o_custkey", (F.col("at_hand") + F.col("late")).alias("kind"))
        )
        # A condition that always holds, so that no plan leaves the kind out: reports over all
        # orders and over those of a delivery make them from the same exchanges.
        heads = self._heads(customers).withColumn("kind", F.coalesce("kind", F.lit(0)))
        lines = self.table("lineitem").where(
            F.col("l_partkey").isNotNull() & F.col("l_suppkey").isNotNull()
        )
        measures = [*_furthest(), F.max("kind").alias("kind")]
        return _made_in_place(lines, heads.where(F.col("kind") >= 0), measures)

    def _heads(self, customers: DataFrame | None = None) -> DataFrame:
        """The source orders, and whether each is `alone`: no other has its customer and day, and
        none repeats its key. With the columns of `customers`, which has a row per customer: one
        shuffle by customer serves both."""
        same_day = Window.partitionBy("o_custkey", "order_day")
        same_key = Window.partitionBy("o_orderkey")
        day, one = F.col("o_orderdate").cast("date"), F.lit(1)
        heads = self.table("orders").select(
            "o_orderkey", "o_custkey", "o_orderstatus", day.alias("order_day")
        )
        if customers is not None:
            heads = heads.join(customers, "o_custkey", "left")
        return (
            heads.withColumn("__of_day", F.count(one).over(same_day))
            .withColumn("__of_key", F.count(one).over(same_key))
            .withColumn("alone", (F.col("__of_day") == one) & (F.col("__of_key") == one))
            .drop("__of_day", "__of_key")
        )

    def _named(self, orders: DataFrame) -> DataFrame:
        statuses = F.array(*[F.lit(status) for status in _STATUSES])
        return orders.select(
            "order_id",
            *_NATURAL_KEY,
            "order_completion_date",
            F.get(statuses, F.col("status_rank")).alias("order_status"),
        )

    def _widen(self, orders: DataFrame, delivered_at: dt.datetime) -> DataFrame:
        return (
            # Craftsmen have more text than products, so they come last: less of it is shuffled.
            orders.join(self.products(), "product_id")
            .join(self.craftsmen(), "craftsman_id")
            .withColumn("load_dttm", moment(delivered_at))
        )


def _made_in_place(lines: DataFrame, heads: DataFrame, measures: list[Column]) -> DataFrame:
    """The orders of lines: those of heads that are alone where they are joined to them, the others
    by their key."""
    joined = lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey"))
    alone = joined.where("alone").groupBy(F.col("l_orderkey").alias("first_order"), *_line_key())
    others = joined.where("not alone").groupBy(*_line_key())
    first = F.min("l_orderkey").alias("first_order")
    return _numbered(alone.agg(*measures)).unionByName(_numbered(others.agg(first, *measures)))


def _is(bit: int) -> Column:
    """Whether an order is of a customer who is at hand for the first delivery, or of one who comes
    with the second."""
    return F.col("kind").bitwiseAND(bit) != 0


def _line_key() -> list[Column]:
    """The natural key of a line that is joined to its order."""
    return [
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("craftsman_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("order_day").alias("order_created_date"),
    ]


def _furthest() -> list[Column]:
    """The status and the completion of an order, from its lines."""
    head, line = F.col("o_orderstatus"), F.col("l_linestatus")
    status_rank = (
        F.when(head == "F", _STATUSES.index(STATUS_DONE))
        .when((head == "P") & (line == "F"), _STATUSES.index(STATUS_DELIVERY))
        .when((head == "P") & (line == "O"), _STATUSES.index(STATUS_IN_PROGRESS))
        .when((head == "O") & (line == "O"), _STATUSES.index(STATUS_CREATED))
    )
    still_open = (line == "O") & (head != "F")
    return [
        F.max(status_rank).alias("status_rank"),
        F.max(F.when(~still_open, F.col("l_shipdate").cast("date"))).alias(
            "order_completion_date"
        ),
    ]


def _numbered(keyed: DataFrame) -> DataFrame:
    """The orders with their numbers. All keys of one first order must be among them."""
    part = (F.col("product_id") * 31 + F.col("craftsman_id")) % _ORDER_PARTS
    among = Window.partitionBy("first_order", "part").orderBy("product_id", "craftsman_id")
    rank = F.row_number().over(among)
    too_many = F.raise_error("an order of more lines than its number has room for")
    numbered = F.when(rank < _ORDER_ROOM, rank).otherwise(too_many.cast("int"))
    start = (F.col("first_order") * _ORDER_PARTS + F.col("part")) * _ORDER_ROOM
    return (
        keyed.withColumn("part", part)
        .withColumn("order_id", start + numbered)
        .drop("first_order", "part")
    )


def _as_fact(orders: DataFrame) -> DataFrame:
    return orders.withColumnsRenamed(
        {
            "customer_id": "order_customer_id",
            "product_id": "order_product_id",
            "craftsman_id": "order_craftsman_id",
        }
    )


def _stamped_where(
    table: DataFrame, stamped: DataFrame, key: str, run_ts: dt.datetime
) -> DataFrame:
    marks = stamped.select(key, F.lit(True).alias("__stamped"))
    return (
        table.join(marks, key, "left")
        .withColumn("load_dttm", F.when(F.col("__stamped"), moment(run_ts)))
        .drop("__stamped")
    )


def _completes_late() -> Column:
    return F.col("order_completion_date") >= F.lit(COMPLETIONS_UNTIL)


def _birthday(key: str) -> Column:
    return F.date_add(F.lit(dt.date(1950, 1, 1)), (F.col(key) % 15000).cast("int"))


def _email(name: str) -> Column:
    return F.concat(F.lower(F.replace(F.col(name), F.lit("#"), F.lit("."))), F.lit("@example.org"))
