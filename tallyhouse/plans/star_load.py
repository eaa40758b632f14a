"""Initial load of the star and the natural-key upserts that keep it current."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyhouse.operators import star
from tallyhouse.operators.conform import conform
from tallyhouse.operators.upsert import upsert
from tallyhouse.sources import schemas


@dataclass(frozen=True, eq=False)
class StarTable:
    """How one star table is keyed and which columns an upsert overwrites."""

    name: str
    schema: T.StructType
    key: str
    natural_key: list[str]
    update: list[str]


CRAFTSMAN = StarTable(
    "d_craftsman",
    schemas.D_CRAFTSMAN,
    "craftsman_id",
    ["craftsman_name", "craftsman_email"],
    ["craftsman_id", "craftsman_address", "craftsman_birthday"],
)
PRODUCT = StarTable(
    "d_product",
    schemas.D_PRODUCT,
    "product_id",
    ["product_name", "product_description", "product_price"],
    ["product_id", "product_type"],
)
CUSTOMER = StarTable(
    "d_customer",
    schemas.D_CUSTOMER,
    "customer_id",
    ["customer_name", "customer_email"],
    ["customer_id", "customer_address", "customer_birthday"],
)
ORDER = StarTable(
    "f_order",
    schemas.F_ORDER,
    "order_id",
    ["order_product_id", "order_craftsman_id", "order_customer_id", "order_created_date"],
    ["order_id", "order_completion_date", "order_status"],
)

STAR_TABLES = [CRAFTSMAN, PRODUCT, CUSTOMER, ORDER]


def source_rows(
    table: StarTable,
    craft_products_orders: DataFrame,
    customers: DataFrame,
    dealt_by_key: bool = False,
) -> DataFrame:
    """The distinct rows of the sources that feed a star table. `dealt_by_key` deals orders, of
    which there are as many as source rows, by their natural key."""
    if table is CRAFTSMAN:
        return star.distinct_craftsmen(craft_products_orders, with_load_time=True)
    if table is PRODUCT:
        return star.distinct_products(craft_products_orders)
    if table is CUSTOMER:
        return star.distinct_customers(customers)
    return star.distinct_orders(craft_products_orders, dealt_by_key)


def load(table: StarTable, rows: DataFrame) -> DataFrame:
    """Full reload: the declared columns with an empty load stamp, so that a loaded row
    does not count as touched before an upsert stamps it."""
    return conform(rows.drop("load_dttm"), table.schema)


def merge(
    table: StarTable,
    target: DataFrame,
    rows: DataFrame,
    run_ts: dt.datetime,
    only_if_changed: bool = False,
) -> DataFrame:
    """The next snapshot of a star table: matched rows are overwritten and stamped, also
    unchanged ones unless `only_if_changed`; unmatched ones are added."""
    return upsert(
        target,
        load(table, rows),
        table.natural_key,
        table.update,
        run_ts,
        only_if_changed=only_if_changed,
    )
