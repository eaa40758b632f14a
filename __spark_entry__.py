
from __future__ import annotations

import datetime as dt
import os
import sys
from collections.abc import Callable
from dataclasses import replace

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

import oracle  # noqa: E402
from tallyhouse.functions.columns import moment  # noqa: E402
from tallyhouse.operators import changes, checks, star  # noqa: E402
from tallyhouse.operators.conform import conform  # noqa: E402
from tallyhouse.operators.star import Star  # noqa: E402
from tallyhouse.operators.upsert import latest_per_key, overwrite  # noqa: E402
from tallyhouse.plans import report, star_load  # noqa: E402
from tallyhouse.plans.refresh import Refresh  # noqa: E402
from tallyhouse.sources import schemas  # noqa: E402
from tallyhouse.sources.inputs import read_new_files  # noqa: E402
from tallyhouse.sources.marketplace import FIRST_RUN, SECOND_RUN, Marketplace  # noqa: E402
from tallyhouse.sources.snapshots import shared_folder  # noqa: E402

try:
    import corpus_pipeline
    from tallyhouse.llm import queries as corpus
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "tallyhouse.llm"):
        raise
    corpus = None

SMOKE_DIR = "/root/testdata/sf0.001"
MARK = dt.date(2001, 6, 15)

_NULLABLE = ["median_completion_time_per_month", "exist_customer_id"]

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    """The customer x month report over the smallest data set."""
    return queries()["mart_full_onepass"](spark, SMOKE_DIR)


def queries() -> dict[str, Query]:
    """One entry per operator; each reads the tables of the given directory."""
    shown = report_queries()
    if corpus is not None:
        shown |= corpus.QUERIES | {"pipeline": corpus_pipeline.run}
    return shown


def report_queries() -> dict[str, Query]:
    """The queries of the customer report, its star and its refresh."""
    shown = {name: _comparable(query) for name, query in _QUERIES.items()}
    shown["conform_mart"] = _comparable(_conform_mart, nullable=[*_NULLABLE, "id"])
    return shown


def oracle_sql() -> dict[str, str]:
    """The same results in SQL, over views of the same tables."""
    shown = oracle.statements()
    if corpus is not None:
        shown |= corpus.ORACLE_SQL
    return shown


def _comparable(query: Query, nullable: list[str] | None = None) -> Query:
    """Show dates and times as text, and numbers with a fraction or with NULLs as DOUBLE:
    engines hand these to their clients in different forms."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        frame = query(spark, sf_dir)
        return frame.select(
            *[_shown(field, nullable or _NULLABLE) for field in frame.schema.fields]
        )

    return run


def _shown(field: T.StructField, nullable: list[str]) -> Column:
    column = F.col(field.name)
    if isinstance(field.dataType, T.DateType):
        column = F.date_format(column, "yyyy-MM-dd")
    elif isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType)):
        column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
    elif isinstance(field.dataType, (T.FloatType, T.DecimalType)) or field.name in nullable:
        column = column.cast("double")
    return column.alias(field.name)


# Star: distinct inputs, loads, joins


def _source_rows(table: star_load.StarTable) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        market = Marketplace(spark, sf_dir)
        return star_load.source_rows(
            table, market.craft_products_orders(), market.customers()
        ).drop("load_dttm")

    return run


def _load(table: star_load.StarTable) -> Query:
    return lambda spark, sf_dir: star_load.load(table, _source_rows(table)(spark, sf_dir))


def _star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.star_join(Marketplace(spark, sf_dir).stamped_star())


def _orphan_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    market = Marketplace(spark, sf_dir)
    stored = market.star()
    return star.orphan_orders(
        Star(
            craftsman=market.earlier_craftsmen(),
            product=market.earlier_products(),
            customer=market.first_delivery().customers,
            order=stored.order,
        )
    )


def _new_customer_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries of customers in one folder, of which the second is read."""
    market, folder = Marketplace(spark, sf_dir), f"{shared_folder(spark)}/customers"
    market.first_delivery().customers.write.parquet(folder)
    _, read = read_new_files(spark, folder, schemas.CUSTOMERS, None)
    market.second_delivery().customers.write.mode("append").parquet(folder)
    return read_new_files(spark, folder, schemas.CUSTOMERS, read)[0]


# Report


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.order_lines(Marketplace(spark, sf_dir).star())


def _measures(*names: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = report.with_month_text(report.monthly_measures(_lines(spark, sf_dir)))
        return report.conform_report(rows).select(*schemas.REPORT_KEY, *names)

    return run


def _top(ranking: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: report.with_month_text(ranking(_lines(spark, sf_dir)))


def _mart_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.conform_report(report.ranked_report_rows(Marketplace(spark, sf_dir).star()))


def _mart_full_onepass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.conform_report(report.report_rows(Marketplace(spark, sf_dir).star()))


def _conform_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = report.report_rows(Marketplace(spark, sf_dir).star())
    return conform(rows, schemas.CUSTOMER_REPORT)


def _mart_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.with_report_ids(_mart_full_onepass(spark, sf_dir))


# Checks


def _check_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = Marketplace(spark, sf_dir).table("lineitem")
    return checks.check_pk(lines, ["l_orderkey", "l_linenumber"])


def _check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.check_not_null(Marketplace(spark, sf_dir).star().order, schemas.F_ORDER.names)


def _craftsmen_by_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Craftsmen of a source whose rows were each loaded on the day of the order: one
    source row per craftsman and day."""
    orders = Marketplace(spark, sf_dir).craft_products_orders()
    return star.distinct_craftsmen(
        orders.withColumn("load_dttm", F.col("order_created_date").cast("timestamp_ntz")),
        with_load_time=True,
    )


def _check_merge_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.check_merge_cardinality(
        Marketplace(spark, sf_dir).earlier_craftsmen(),
        _craftsmen_by_load(spark, sf_dir),
        star_load.CRAFTSMAN.natural_key,
    )


def _latest_craftsman(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(
        _craftsmen_by_load(spark, sf_dir), star_load.CRAFTSMAN.natural_key, by="load_dttm"
    )


# Upserts


def _loaded(table: star_load.StarTable, rows: DataFrame) -> DataFrame:
    """A star table as the first run left it."""
    return star_load.load(table, rows).withColumn("load_dttm", moment(FIRST_RUN))


def _merge_craftsman(spark: SparkSession, sf_dir: str) -> DataFrame:
    market = Marketplace(spark, sf_dir)
    return star_load.merge(
        star_load.CRAFTSMAN,
        _loaded(star_load.CRAFTSMAN, market.earlier_craftsmen()),
        star.distinct_craftsmen(market.craft_products_orders()),
        SECOND_RUN,
    )


def _merge_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    market = Marketplace(spark, sf_dir)
    return star_load.merge(
        star_load.PRODUCT,
        _loaded(star_load.PRODUCT, market.earlier_products()),
        star.distinct_products(market.craft_products_orders()),
        SECOND_RUN,
    )


def _merge_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    market = Marketplace(spark, sf_dir)
    return star_load.merge(
        star_load.CUSTOMER,
        _loaded(star_load.CUSTOMER, market.first_delivery().customers),
        star.distinct_customers(market.second_delivery().customers),
        SECOND_RUN,
    )


def _merge_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    market = Marketplace(spark, sf_dir)
    before = star.distinct_orders(market.first_delivery().craft_products_orders)
    return star_load.merge(
        star_load.ORDER,
        _loaded(star_load.ORDER, before),
        star.distinct_orders(market.second_delivery().craft_products_orders),
        SECOND_RUN,
    )


def _merge_touch_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    market = Marketplace(spark, sf_dir)
    return star_load.merge(
        star_load.CUSTOMER,
        _loaded(star_load.CUSTOMER, market.first_delivery().customers),
        star.distinct_customers(market.customers()),
        SECOND_RUN,
        only_if_changed=True,
    )


# Incremental refresh


def _hwm_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = Marketplace(spark, sf_dir).table("orders")
    return changes.hwm_read(orders.select(F.col("o_orderdate").cast("date").alias("load_dttm")))


def _delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.delta(Marketplace(spark, sf_dir).stamped_star(), MARK)


def _hwm_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.hwm_next(_delta(spark, sf_dir), FIRST_RUN)


def _earlier_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report before the second delivery, computed from the first one. Its orders are dealt by
    product once, to make them distinct and to join the products."""
    market = Marketplace(spark, sf_dir)
    first = market.first_delivery()
    delivered = first.craft_products_orders.repartition("product_id")
    orders = star_load.load(
        star_load.ORDER, star_load.source_rows(star_load.ORDER, delivered, first.customers)
    )
    stored = market.star()
    customers = star_load.load(star_load.CUSTOMER, first.customers)
    before = Star(stored.craftsman, stored.product, customers, orders)
    return report.conform_report(report.report_rows(before, dealt_by_customer=True))


def _known_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers that the earlier report has: those of the first delivery's orders."""
    first = Marketplace(spark, sf_dir).first_delivery()
    bought = first.craft_products_orders.select("customer_id").distinct()
    return first.customers.select("customer_id").join(bought, "customer_id", "left_semi")


def _delta_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.flag_known(_delta(spark, sf_dir), _known_customers(spark, sf_dir))


def _new_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.new_customers(_delta(spark, sf_dir), _known_customers(spark, sf_dir))


def _affected_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.affected_customers(_delta(spark, sf_dir))


def _affected_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.affected_months(_delta(spark, sf_dir))


def _affected_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.orders_of(
        Marketplace(spark, sf_dir).stamped_star().order, _affected_customers(spark, sf_dir)
    )


def _mart_insert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    market = Marketplace(spark, sf_dir)
    stored = market.star()
    newcomers = _new_customers(spark, sf_dir)
    fresh = replace(stored, order=changes.orders_of(stored.order, newcomers))
    return report.conform_report(report.report_rows(fresh))


def _mart_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both reports make their orders in place: neither shuffles all lines by their key. They are
    folded from orders dealt by customer, as few of all orders meet one of their customer month."""
    full = report.report_rows(
        Marketplace(spark, sf_dir).star(in_place=True), dealt_by_customer=True
    )
    return overwrite(
        _earlier_report(spark, sf_dir),
        report.conform_report(full),
        schemas.REPORT_KEY,
        [name for name in schemas.REPORT_COLUMNS if name not in schemas.REPORT_KEY],
        null_safe=True,
    )


def _mart_incremental(exact: bool) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        market = Marketplace(spark, sf_dir)
        refresh = Refresh(
            spark, shared_folder(spark), exact_mark=exact, only_if_changed=exact
        )
        for delivery, run_ts in (
            (market.first_delivery(), FIRST_RUN),
            (market.second_delivery(), SECOND_RUN),
        ):
            # A delivery is a table that lies ready: it is written once and read three times.
            orders = refresh.tables.write(
                "craft_products_orders", delivery.craft_products_orders, run_ts
            )
            refreshed = refresh.run(orders, delivery.customers, run_ts)
        return refreshed.drop("id")

    return run


_QUERIES: dict[str, Query] = {
    "distinct_craftsman": _source_rows(star_load.CRAFTSMAN),
    "distinct_product": _source_rows(star_load.PRODUCT),
    "distinct_customer": _source_rows(star_load.CUSTOMER),
    "distinct_order": _source_rows(star_load.ORDER),
    "new_customer_files": _new_customer_files,
    "load_craftsman": _load(star_load.CRAFTSMAN),
    "load_product": _load(star_load.PRODUCT),
    "load_customer": _load(star_load.CUSTOMER),
    "load_order": _load(star_load.ORDER),
    "star_join": _star_join,
    "orphan_orders": _orphan_orders,
    "monthly_agg": _measures(
        "customer_paid",
        "customer_earned",
        "customer_order_count",
        "customer_avg_price_per_month",
    ),
    "status_counts": _measures(
        "number_of_orders_created_per_month",
        "number_of_orders_in_progress_per_month",
        "number_of_orders_in_delivery_per_month",
        "number_of_orders_done_per_month",
        "number_of_orders_not_done_per_month",
    ),
    "median_days": _measures("median_completion_time_per_month"),
    "top_product": _top(report.top_products),
    "top_craftsman": _top(report.top_craftsmen),
    "mart_full": _mart_full,
    "mart_full_onepass": _mart_full_onepass,
    "conform_mart": _conform_mart,
    "mart_ids": _mart_ids,
    "check_pk": _check_pk,
    "check_not_null": _check_not_null,
    "check_merge_cardinality": _check_merge_cardinality,
    "latest_craftsman": _latest_craftsman,
    "merge_craftsman": _merge_craftsman,
    "merge_product": _merge_product,
    "merge_customer": _merge_customer,
    "merge_order": _merge_order,
    "merge_touch_changed": _merge_touch_changed,
    "hwm_read": _hwm_read,
    "hwm_next": _hwm_next,
    "delta": _delta,
    "delta_flagged": _delta_flagged,
    "new_customers": _new_customers,
    "affected_customers": _affected_customers,
    "affected_months": _affected_months,
    "affected_history": _affected_history,
    "mart_insert_rows": _mart_insert_rows,
    "mart_update": _mart_update,
    "mart_incremental": _mart_incremental(exact=False),
    "mart_incremental_exact": _mart_incremental(exact=True),
}
