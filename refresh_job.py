"""Refresh the customer report from one delivery; for spark-submit.

    spark-submit refresh_job.py --orders /in/craft_products_orders --customers /in/customers \\
        --root /shared/tallyhouse --run-ts 2024-05-01T04:30:00
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from tallyhouse.plans.refresh import LastRun, Refresh
from tallyhouse.session import settings
from tallyhouse.sources.inputs import read_new_files, read_source
from tallyhouse.sources.schemas import CRAFT_PRODUCTS_ORDERS, CUSTOMERS


def utc_time(text: str) -> dt.datetime:
    """The time without a zone, in UTC; a time that has no zone is taken to be in UTC."""
    time = dt.datetime.fromisoformat(text)
    return time if time.tzinfo is None else time.astimezone(dt.UTC).replace(tzinfo=None)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--orders", required=True, help="folder or table of the wide source")
    parser.add_argument("--customers", required=True, help="folder or table of the customers")
    parser.add_argument("--root", required=True, help="shared folder of the star and report")
    parser.add_argument("--run-ts", required=True, type=utc_time)
    parser.add_argument("--rebuild", action="store_true", help="start over from this delivery")
    parser.add_argument("--exact-mark", action="store_true")
    parser.add_argument("--only-if-changed", action="store_true")
    parser.add_argument("--keep-latest", action="store_true")
    parser.add_argument("--wide-keys", action="store_true")
    parser.add_argument("--export", help="folder or table for a whole copy of the report")
    parser.add_argument(
        "--shuffle-gib", type=int, default=256, help="size of the largest shuffle"
    )
    parser.add_argument("--publish", help="database for views of the star, the report and the log")
    parser.add_argument(
        "--clean", action="store_true", help="delete what this run has superseded, and its stages"
    )
    parser.add_argument(
        "--new-files",
        action="store_true",
        help="read only files that were written since those of the last run; both sources must "
        "be folders",
    )
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("customer report refresh").getOrCreate()
    cores = spark.sparkContext.defaultParallelism
    for name, value in settings(args.shuffle_gib * 2**30, cores).items():
        spark.conf.set(name, value)
    refresh = Refresh(
        spark,
        args.root,
        exact_mark=args.exact_mark,
        only_if_changed=args.only_if_changed,
        keep_latest=args.keep_latest,
        wide_keys=args.wide_keys,
    )
    orders_read = customers_read = None
    if args.new_files:
        last = LastRun() if args.rebuild else refresh.last_run()
        orders, orders_read = read_new_files(
            spark, args.orders, CRAFT_PRODUCTS_ORDERS, last.orders_read
        )
        customers, customers_read = read_new_files(
            spark, args.customers, CUSTOMERS, last.customers_read
        )
    else:
        orders = read_source(spark, args.orders, CRAFT_PRODUCTS_ORDERS)
        customers = read_source(spark, args.customers, CUSTOMERS)
    report = refresh.run(
        orders, customers, args.run_ts, args.rebuild, orders_read, customers_read
    )
    if args.publish:
        refresh.publish(args.publish)
    if args.clean:
        refresh.clean()
    if args.export:
        writer = report.write.mode("overwrite")
        writer.parquet(args.export) if "/" in args.export else writer.saveAsTable(args.export)


if __name__ == "__main__":
    main()
