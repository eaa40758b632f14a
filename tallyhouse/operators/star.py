"""The star schema: distinct inputs from the sources, and the joins over it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.columns import report_month

_CRAFTSMAN = [
    "craftsman_id", "craftsman_name", "craftsman_address", "craftsman_birthday",
    "craftsman_email",
]
_PRODUCT = [
    "product_id", "product_name", "product_description", "product_type", "product_price",
]
_CUSTOMER = [
    "customer_id", "customer_name", "customer_address", "customer_birthday", "customer_email",
]
_ORDER = [
    "order_id", "product_id", "craftsman_id", "customer_id", "order_created_date",
    "order_completion_date", "order_status",
]
_ORDER_KEY = ["product_id", "craftsman_id", "customer_id", "order_created_date"]


@dataclass(frozen=True)
class Star:
    """The four star tables."""

    craftsman: DataFrame
    product: DataFrame
    customer: DataFrame
    order: DataFrame


def distinct_craftsmen(orders: DataFrame, with_load_time: bool = False) -> DataFrame:
    """Distinct craftsmen of the wide source. With the load time a craftsman who came in
    two loads is two rows, which the upsert then refuses or resolves."""
    return orders.select(*_CRAFTSMAN, *(["load_dttm"] if with_load_time else [])).distinct()


def distinct_products(orders: DataFrame) -> DataFrame:
    return orders.select(*_PRODUCT).distinct()


def distinct_customers(customers: DataFrame) -> DataFrame:
    return customers.select(*_CUSTOMER).distinct()


def distinct_orders(orders: DataFrame, dealt_by_key: bool = False) -> DataFrame:
    """Distinct orders, with the key columns named as in the fact table. Equal orders have equal
    keys: dealt by the natural key, they are made distinct where rows of one key can be counted
    without another shuffle."""
    rows = orders.select(*_ORDER)
    return (
        (rows.repartition(*_ORDER_KEY) if dealt_by_key else rows)
        .distinct()
        .withColumnsRenamed(
            {
                "customer_id": "order_customer_id",
                "product_id": "order_product_id",
                "craftsman_id": "order_craftsman_id",
            }
        )
    )


def star_join(star: Star) -> DataFrame:
    """Every order with its customer, product and craftsman; an order that lacks one of
    them is left out. No join strategy is forced: a dimension is broadcast when Spark
    measures it below the session's threshold, and sort-merged with skew handling when
    it is not. The customer's attributes, the widest, come last: no shuffle carries them."""
    return (
        star.order.alias("fact")
        .join(
            star.product.alias("product"),
            F.col("fact.order_product_id") == F.col("product.product_id"),
        )
        .join(
            star.craftsman.alias("craftsman"),
            F.col("fact.order_craftsman_id") == F.col("craftsman.craftsman_id"),
        )
        .join(
            star.customer.alias("customer"),
            F.col("fact.order_customer_id") == F.col("customer.customer_id"),
        )
        .select(
            F.col("customer.customer_id"),
            "customer_name",
            "customer_address",
            "customer_birthday",
            "customer_email",
            "order_id",
            "product_id",
            "product_name",
            "product_price",
            "product_type",
            "order_completion_date",
            "order_created_date",
            "order_status",
            report_month(F.col("order_created_date")).alias("report_month"),
            "craftsman_name",
            F.col("fact.load_dttm").alias("order_load_dttm"),
            F.col("craftsman.load_dttm").alias("craftsman_load_dttm"),
            F.col("customer.load_dttm").alias("customers_load_dttm"),
            F.col("product.load_dttm").alias("products_load_dttm"),
        )
    )


def orphan_orders(star: Star) -> DataFrame:
    """Orders that the star join leaves out, and which of their dimensions is missing.
    Keys are unique in a dimension, so the left joins keep one row per order."""
    marked = (
        star.order.join(
            star.craftsman.select(
                F.col("craftsman_id").alias("order_craftsman_id"),
                F.lit(True).alias("has_craftsman"),
            ),
            "order_craftsman_id",
            "left",
        )
        .join(
            star.customer.select(
                F.col("customer_id").alias("order_customer_id"),
                F.lit(True).alias("has_customer"),
            ),
            "order_customer_id",
            "left",
        )
        .join(
            star.product.select(
                F.col("product_id").alias("order_product_id"),
                F.lit(True).alias("has_product"),
            ),
            "order_product_id",
            "left",
        )
    )
    return marked.select(
        "order_id",
        "order_customer_id",
        "order_product_id",
        "order_craftsman_id",
        F.col("has_craftsman").isNull().alias("no_craftsman"),
        F.col("has_customer").isNull().alias("no_customer"),
        F.col("has_product").isNull().alias("no_product"),
    ).where("no_craftsman OR no_customer OR no_product")
