"""Declared schemas and keys of the source, star, report and run-log tables."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "FLOAT": T.FloatType(),
    "STRING": T.StringType(),
    "DATE": T.DateType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "BOOLEAN": T.BooleanType(),
    "STRINGS": T.ArrayType(T.StringType()),
}


def _schema(columns: str, required: tuple[str, ...] = ()) -> T.StructType:
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType(
        [T.StructField(name, _TYPES[kind], name not in required) for name, kind in pairs]
    )


# Table names, column names, types and required columns are the data
# model that users of the report already know.

D_CRAFTSMAN = _schema(
    "craftsman_id BIGINT, craftsman_name STRING, craftsman_address STRING, "
    "craftsman_birthday DATE, craftsman_email STRING, load_dttm TIMESTAMP_NTZ",
    required=(
        "craftsman_id", "craftsman_name", "craftsman_address",
        "craftsman_birthday", "craftsman_email",
    ),
)

D_PRODUCT = _schema(
    "product_id BIGINT, product_name STRING, product_description STRING, "
    "product_type STRING, product_price INT, load_dttm TIMESTAMP_NTZ",
    required=("product_id", "product_name", "product_description", "product_type"),
)

D_CUSTOMER = _schema(
    "customer_id BIGINT, customer_name STRING, customer_address STRING, "
    "customer_birthday DATE, customer_email STRING, load_dttm TIMESTAMP_NTZ",
    required=("customer_id", "customer_address", "customer_birthday", "customer_email"),
)

F_ORDER = _schema(
    "order_id BIGINT, order_customer_id BIGINT, order_product_id BIGINT, "
    "order_craftsman_id BIGINT, order_created_date DATE, order_completion_date DATE, "
    "order_status STRING, load_dttm TIMESTAMP_NTZ",
    required=("order_id",),
)

CUSTOMER_REPORT = _schema(
    "id INT, customer_id INT, customer_name STRING, customer_address STRING, "
    "customer_birthday DATE, customer_email STRING, customer_paid FLOAT, "
    "customer_earned FLOAT, customer_order_count INT, customer_avg_price_per_month FLOAT, "
    "median_completion_time_per_month INT, "
    "customer_most_popular_product_per_month STRING, customer_most_popular_craftsman STRING, "
    "number_of_orders_created_per_month INT, number_of_orders_in_progress_per_month INT, "
    "number_of_orders_in_delivery_per_month INT, number_of_orders_done_per_month INT, "
    "number_of_orders_not_done_per_month INT, report_month STRING",
    required=("id",),
)

CRAFT_PRODUCTS_ORDERS = _schema(
    "craftsman_id BIGINT, craftsman_name STRING, craftsman_address STRING, "
    "craftsman_birthday DATE, craftsman_email STRING, product_id BIGINT, "
    "product_name STRING, product_description STRING, product_type STRING, "
    "product_price INT, order_id BIGINT, customer_id BIGINT, order_created_date DATE, "
    "order_completion_date DATE, order_status STRING, load_dttm TIMESTAMP_NTZ",
    required=(
        "craftsman_id", "craftsman_name", "craftsman_address", "craftsman_birthday",
        "craftsman_email", "product_id", "product_name", "product_description",
        "product_type", "order_id",
    ),
)

CUSTOMERS = _schema(
    "customer_id BIGINT, customer_name STRING, customer_address STRING, "
    "customer_birthday DATE, customer_email STRING",
    required=("customer_id", "customer_address", "customer_birthday", "customer_email"),
)

# End of fixed values.

# One row per finished refresh. `load_dttm` is the day-precision mark, `mark_ts` the exact
# one. `run_ts` names the directories that the run wrote, `dimensions` the tables among
# them, `order_months` and `report_months` the months; `last_report_id` is the greatest id
# so far. `orders_read` and `customers_read` are the times up to which files of the sources were
# taken, if runs take new files only. Rows before the last one that `rebuilt` everything are
# history.
RUN_LOG = _schema(
    "id BIGINT, load_dttm DATE, mark_ts TIMESTAMP_NTZ, run_ts TIMESTAMP_NTZ, "
    "last_report_id BIGINT, dimensions STRINGS, order_months STRINGS, report_months STRINGS, "
    "rebuilt BOOLEAN, orders_read TIMESTAMP_NTZ, customers_read TIMESTAMP_NTZ",
    required=("id", "load_dttm", "run_ts"),
)

REPORT_KEY = ["customer_id", "report_month"]
CUSTOMER_ATTRIBUTES = [
    "customer_name", "customer_address", "customer_birthday", "customer_email",
]
REPORT_COLUMNS = [name for name in CUSTOMER_REPORT.names if name != "id"]


def widened(schema: T.StructType, *names: str) -> T.StructType:
    """The schema with the named INT columns as BIGINT, for data past 2**31 keys."""
    return T.StructType(
        [
            T.StructField(f.name, T.LongType() if f.name in names else f.dataType, f.nullable)
            for f in schema.fields
        ]
    )


def required_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]
