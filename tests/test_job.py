import pathlib
import sys

import pytest

from test_golden import (
    AFTER_1,
    AFTER_2,
    BATCH_1,
    BATCH_2,
    FIRST,
    SECOND,
    THIRD,
    customers,
    shown,
    wide,
)

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

import refresh_job  # noqa: E402
from tallyhouse.operators.checks import ConstraintViolation  # noqa: E402
from tallyhouse.plans.refresh import Refresh  # noqa: E402
from tallyhouse.session import settings  # noqa: E402
from tallyhouse.sources.inputs import read_source  # noqa: E402
from tallyhouse.sources.schemas import CUSTOMERS  # noqa: E402
from tallyhouse.sources.snapshots import shared_folder  # noqa: E402


@pytest.fixture(autouse=True)
def own_settings(spark):
    """A job changes the settings of its session, which here is that of all tests."""
    before = {name: spark.conf.get(name, None) for name in settings(1, 1)}
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_deliveries_in_report_out(spark, tmp_path):
    def run(orders, people, run_ts, *more):
        orders.write.mode("overwrite").parquet(f"{tmp_path}/orders")
        people.write.mode("overwrite").parquet(f"{tmp_path}/customers")
        refresh_job.main(
            [
                "--orders", f"{tmp_path}/orders", "--customers", f"{tmp_path}/customers",
                "--root", f"{tmp_path}/root", "--run-ts", run_ts,
                "--export", f"{tmp_path}/report", "--shuffle-gib", "1", *more,
            ]
        )
        return spark.read.parquet(f"{tmp_path}/report")

    run(wide(spark, BATCH_1), customers(spark, 1, 2), "2023-03-01T12:00:00")
    report = run(wide(spark, BATCH_2), customers(spark, 3), "2023-03-02T12:00:00")
    assert shown(report) == AFTER_2
    again = run(
        wide(spark, BATCH_1), customers(spark, 1, 2), "2023-03-03T12:00:00", "--rebuild"
    )
    assert shown(again) == AFTER_1
    assert sorted(r.id for r in again.collect()) == [1, 2, 3]


def test_sources_from_the_catalog(spark):
    customers(spark, 1, 2).withColumnRenamed("customer_name", "other").createOrReplaceTempView(
        "incomplete"
    )
    with pytest.raises(ValueError, match="customer_name"):
        read_source(spark, "incomplete", CUSTOMERS)
    customers(spark, 1, 2).selectExpr("*", "1 AS extra").createOrReplaceTempView("complete")
    assert read_source(spark, "complete", CUSTOMERS).columns == CUSTOMERS.names


def test_shared_folder_is_the_one_the_session_names(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark), shared_folder(spark)
    assert first.startswith(shared) and second.startswith(shared) and first != second


def test_settings_grow_with_the_shuffle():
    assert settings(10 * 2**40, 64)["spark.sql.shuffle.partitions"] == "81920"
    assert settings(2**20, 64)["spark.sql.shuffle.partitions"] == "64"


def test_a_time_with_a_zone_is_taken_in_utc():
    assert refresh_job.utc_time("2023-03-01T12:00:00+02:00").isoformat() == "2023-03-01T10:00:00"
    assert refresh_job.utc_time("2023-03-01T12:00:00Z").isoformat() == "2023-03-01T12:00:00"
    assert refresh_job.utc_time("2023-03-01T12:00:00").tzinfo is None


def test_views_and_cleaning(spark, tmp_path):
    refresh = Refresh(spark, str(tmp_path))
    refresh.run(wide(spark, BATCH_1), customers(spark, 1, 2), FIRST)
    refresh.run(wide(spark, BATCH_2), customers(spark, 3), SECOND)
    refresh.publish("default")
    try:
        assert shown(spark.table("default.customer_report_datamart")) == AFTER_2
        assert spark.table("default.f_order").count() == refresh.star().order.count() == 8
        assert spark.table("default.d_customer").count() == 3
        assert spark.table("default.run_log").count() == 2
    finally:
        for name in ("customer_report_datamart", "f_order", "d_customer", "d_craftsman",
                     "d_product", "run_log"):
            spark.sql(f"DROP VIEW IF EXISTS default.{name}")
    refresh.clean()
    assert shown(refresh.report()) == AFTER_2
    assert refresh.star().order.count() == 8
    left = [p for p in tmp_path.rglob("run=*") if p.is_dir()]
    assert not [p for p in left if p.parent.name.endswith(("_source", "_changes", "_rows"))]
    refresh.run(wide(spark, BATCH_1), customers(spark, 1, 2), THIRD)
    assert len(shown(refresh.report())) == len(AFTER_2)


def files_below(path):
    return {str(p.relative_to(path)) for p in path.rglob("*.parquet")}


def test_cleaning_sweeps_up_after_a_run_that_died(spark, tmp_path, monkeypatch):
    """A run that dies after its first writes is not in the log; nor is what it left after that."""
    refresh = Refresh(spark, str(tmp_path), exact_mark=True, only_if_changed=True)
    refresh.run(wide(spark, BATCH_1), customers(spark, 1, 2), FIRST)
    refresh.clean()
    before = files_below(tmp_path)

    def die(*_):
        raise RuntimeError("the driver is gone")

    monkeypatch.setattr("tallyhouse.plans.refresh.affected_summary", die)
    with pytest.raises(RuntimeError, match="gone"):
        refresh.run(wide(spark, BATCH_2), customers(spark, 3), SECOND)
    monkeypatch.undo()
    left = files_below(tmp_path) - before
    assert any("f_order/run=" in f for f in left) and any("_source/" in f for f in left)
    refresh.clean()
    assert files_below(tmp_path) == before
    assert not [p for p in tmp_path.rglob("run=20230302*")]
    assert shown(refresh.report()) == AFTER_1
    # The run after it is not hindered, and cleaning again finds the parts that it replaced.
    report = refresh.run(wide(spark, BATCH_2), customers(spark, 3), THIRD)
    assert shown(report) == AFTER_2
    refresh.clean()
    assert shown(refresh.report()) == AFTER_2
    last = refresh.last_run()
    for name, months in (("f_order", last.order_months), (
        "customer_report_datamart", last.report_months
    )):
        parts = {p.name for p in (tmp_path / name).glob("run=*/*") if p.is_dir()}
        assert parts == {f"month_part={m}" for m in months}


def test_a_view_is_one_relation(spark, tmp_path):
    refresh = Refresh(spark, str(tmp_path))
    refresh.run(wide(spark, BATCH_1), customers(spark, 1, 2), FIRST)
    spark.sql("CREATE DATABASE IF NOT EXISTS shown_once")
    try:
        refresh.publish("shown_once")
        plan = spark.table("shown_once.f_order")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "Union" not in plan
        assert spark.table("shown_once.f_order").count() == 6
    finally:
        spark.sql("DROP DATABASE shown_once CASCADE")


def test_only_new_files_are_read(spark, tmp_path, monkeypatch):
    """Two sets of files in the same folders, and then none."""
    orders, people = f"{tmp_path}/orders", f"{tmp_path}/customers"
    read = []
    real = Refresh.run

    def spy(self, orders, customers, *rest):
        read.append((len(orders.inputFiles()), orders.count(), customers.count()))
        return real(self, orders, customers, *rest)

    monkeypatch.setattr(Refresh, "run", spy)

    def run(run_ts, *more):
        refresh_job.main(
            ["--orders", orders, "--customers", people, "--root", f"{tmp_path}/root",
             "--run-ts", run_ts, "--new-files", "--exact-mark", "--only-if-changed",
             "--shuffle-gib", "1", *more]
        )
        return Refresh(spark, f"{tmp_path}/root")

    wide(spark, BATCH_1).coalesce(1).write.parquet(orders)
    customers(spark, 1, 2).coalesce(1).write.parquet(people)
    run("2023-03-01T12:00:00")
    wide(spark, BATCH_2).coalesce(1).write.mode("append").parquet(orders)
    customers(spark, 3).coalesce(1).write.mode("append").parquet(people)
    refresh = run("2023-03-02T12:00:00")
    assert shown(refresh.report()) == AFTER_2
    refresh = run("2023-03-03T12:00:00")
    assert shown(refresh.report()) == AFTER_2
    assert read == [(1, 6, 2), (1, 3, 1), (0, 0, 0)]
    assert refresh.last_run().orders_read is not None
    # Starting over takes all files again, in which order 3 comes in two states.
    with pytest.raises(ConstraintViolation, match="f_order: double keys.*'order_id': 3"):
        run("2023-03-04T12:00:00", "--rebuild")
    assert read[-1] == (2, 9, 3)
    assert shown(refresh.report()) == AFTER_2
