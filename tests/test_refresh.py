"""Refreshes over the given tables and over small awkward deliveries."""

import datetime as dt
import pathlib

import pytest
from pyspark.sql import functions as F

from test_golden import AFTER_2, BATCH_1, BATCH_2, FIRST, SECOND, THIRD, customers, shown, wide

from tallyhouse.operators import changes
from tallyhouse.operators.checks import ConstraintViolation
from tallyhouse.operators.star import orphan_orders
from tallyhouse.plans.refresh import Refresh
from tallyhouse.plans.report import conform_report, report_rows
from tallyhouse.sources import schemas
from tallyhouse.sources.marketplace import FIRST_RUN, SECOND_RUN, Marketplace

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def refreshed(spark, tmp_path_factory):
    """Both deliveries, in both modes."""
    market = Marketplace(spark, DATA)
    runs = {}
    for exact in (False, True):
        refresh = Refresh(
            spark, str(tmp_path_factory.mktemp("run")), exact_mark=exact, only_if_changed=exact
        )
        for delivery, run_ts in (
            (market.first_delivery(), FIRST_RUN),
            (market.second_delivery(), SECOND_RUN),
        ):
            refresh.run(delivery.craft_products_orders, delivery.customers, run_ts)
        runs[exact] = refresh
    return runs


def affected(refresh, run_ts):
    return refresh.tables.read(
        "affected_months", "customer_id BIGINT", run_ts
    ).distinct().count()


def test_exact_marks_affect_fewer_customers(refreshed):
    total = refreshed[False].star().customer.count()
    assert affected(refreshed[False], SECOND_RUN) == total
    assert affected(refreshed[True], SECOND_RUN) < total


def test_incremental_equals_full(spark, refreshed):
    full = conform_report(report_rows(Marketplace(spark, DATA).star()))
    for refresh in refreshed.values():
        rows = refresh.report().select(*full.columns)
        assert rows.exceptAll(full).isEmpty() and full.exceptAll(rows).isEmpty()


def test_ids_stay_and_continue(refreshed):
    for refresh in refreshed.values():
        ids = sorted(r.id for r in refresh.report().select("id").collect())
        assert ids == list(range(1, len(ids) + 1))


def test_report_key_is_unique(refreshed):
    report = refreshed[True].report()
    assert report.select(*schemas.REPORT_KEY).distinct().count() == report.count()


def test_marks(refreshed):
    marks = [
        (r.id, r.load_dttm, r.mark_ts, r.run_ts)
        for r in refreshed[True].tables.log().orderBy("id").collect()
    ]
    assert marks == [
        (1, FIRST_RUN.date(), FIRST_RUN, FIRST_RUN),
        (2, SECOND_RUN.date(), SECOND_RUN, SECOND_RUN),
    ]


def test_a_run_writes_only_the_months_it_changes(spark, tmp_path):
    refresh = Refresh(spark, str(tmp_path), exact_mark=True, only_if_changed=True)
    refresh.run(wide(spark, BATCH_1), customers(spark, 1, 2), FIRST)
    late = [(9, 2, "Rug", "Bob", dt.date(2023, 3, 3), None, "created")]
    report = refresh.run(wide(spark, late), customers(spark), SECOND)
    log = {r.run_ts: r for r in refresh.tables.log().collect()}
    assert log[FIRST].order_months == log[FIRST].report_months == ["2023-01", "2023-02"]
    assert log[SECOND].order_months == log[SECOND].report_months == ["2023-03"]
    for table in ("f_order", "customer_report_datamart"):
        parts = {
            p.parent.parent.name + "/" + p.parent.name
            for p in pathlib.Path(tmp_path, table).glob("*/*/*.parquet")
        }
        assert len(parts) == 3
    assert report.count() == 4
    assert refresh.star().order.count() == 7


def test_an_empty_delivery(spark, tmp_path):
    refresh = Refresh(spark, str(tmp_path), exact_mark=True, only_if_changed=True)
    refresh.run(wide(spark, BATCH_1), customers(spark, 1, 2), FIRST)
    before = shown(refresh.report())
    refresh.run(wide(spark, []), customers(spark), SECOND)
    assert shown(refresh.report()) == before
    last = refresh.last_run()
    # Nothing was touched: the exact mark stands still, and the day is the run's.
    assert (last.mark_ts, last.load_dttm, last.runs) == (FIRST, SECOND.date(), 2)


def test_nothing_at_all(spark, tmp_path):
    refresh = Refresh(spark, str(tmp_path))
    assert refresh.run(wide(spark, []), customers(spark), FIRST).count() == 0
    assert shown(refresh.run(wide(spark, BATCH_1), customers(spark, 1, 2), SECOND))


def test_orders_without_a_day(spark, tmp_path):
    """They never match, so each delivery adds them; their group has no month, and is
    updated rather than repeated."""
    refresh = Refresh(spark, str(tmp_path))
    first = [(1, 1, "Mug", "Ann", None, None, "created")]
    second = [(2, 1, "Mug", "Ann", None, None, "created")]
    refresh.run(wide(spark, first), customers(spark, 1), FIRST)
    report = refresh.run(wide(spark, second), customers(spark, 1), SECOND).collect()
    assert [(r.id, r.report_month, r.customer_order_count) for r in report] == [(1, None, 2)]
    assert report[0].customer_most_popular_craftsman is None


def test_wide_keys(spark, tmp_path):
    far = 2**40
    moved = [(o, c + far, *rest) for o, c, *rest in BATCH_1]
    people = customers(spark, 1, 2).withColumn("customer_id", F.col("customer_id") + far)
    refresh = Refresh(spark, str(tmp_path), wide_keys=True)
    report = refresh.run(wide(spark, moved), people, FIRST)
    assert sorted((r.id, r.customer_id - far) for r in report.collect()) == [
        (1, 1), (2, 1), (3, 2),
    ]


def test_two_load_times_of_one_craftsman(spark, tmp_path):
    def twice():
        return wide(spark, BATCH_1, FIRST).unionByName(wide(spark, BATCH_1, SECOND))

    refresh = Refresh(spark, str(tmp_path))
    refresh.run(wide(spark, BATCH_1), customers(spark, 1, 2), FIRST)
    with pytest.raises(ConstraintViolation, match="several source rows"):
        refresh.run(twice(), customers(spark, 1, 2), SECOND)
    latest = Refresh(spark, str(tmp_path), keep_latest=True)
    assert len(shown(latest.run(twice(), customers(spark, 1, 2), THIRD))) == 3


def test_a_changed_price_is_a_double_key(spark, tmp_path):
    refresh = Refresh(spark, str(tmp_path))
    refresh.run(wide(spark, BATCH_1), customers(spark, 1, 2), FIRST)
    dearer = wide(spark, BATCH_2).withColumn("product_price", F.col("product_price") + 1)
    with pytest.raises(ConstraintViolation, match="d_product: double keys"):
        refresh.run(dearer, customers(spark, 3), SECOND)


def test_a_required_column_without_a_value(spark, tmp_path):
    orders = wide(spark, BATCH_1)
    broken = orders.withColumn(
        "product_type", F.when(F.col("product_name") != "Rug", F.col("product_type"))
    )
    with pytest.raises(ConstraintViolation, match="d_product: required.*product_type"):
        Refresh(spark, str(tmp_path)).run(broken, customers(spark, 1, 2), FIRST)


def test_a_re_keyed_craftsman_orphans_the_old_orders(spark, tmp_path):
    refresh = Refresh(spark, str(tmp_path))
    refresh.run(wide(spark, BATCH_1), customers(spark, 1, 2), FIRST)
    renumbered = wide(spark, BATCH_2[1:]).withColumn("craftsman_id", F.col("craftsman_id") + 10)
    refresh.run(renumbered, customers(spark, 3), SECOND)
    orphans = orphan_orders(refresh.star()).collect()
    assert {r.order_id for r in orphans} == {2, 3}
    assert all(r.no_craftsman and not r.no_customer and not r.no_product for r in orphans)


def test_rows_that_were_never_stamped_are_not_touched(spark):
    market = Marketplace(spark, DATA)
    assert changes.delta(market.star(), changes.FIRST_MARK).isEmpty()
    empty = changes.delta(market.star(), changes.FIRST_MARK)
    assert changes.hwm_next(empty, SECOND_RUN).first().load_dttm == SECOND_RUN.date()


def test_the_first_mark(spark):
    log = spark.createDataFrame([], schemas.RUN_LOG)
    assert changes.hwm_read(log).first().load_dttm == dt.date(1900, 1, 1)


def test_a_delivery_that_changes_nothing_writes_nothing(spark, tmp_path):
    refresh = Refresh(spark, str(tmp_path), exact_mark=True, only_if_changed=True)
    refresh.run(wide(spark, BATCH_1), customers(spark, 1, 2), FIRST)
    before = refresh.star(), shown(refresh.report())
    report = refresh.run(wide(spark, BATCH_1), customers(spark, 1, 2), SECOND)
    assert shown(report) == before[1]
    log = {r.run_ts: r for r in refresh.tables.log().collect()}
    assert log[FIRST].dimensions == ["d_craftsman", "d_product", "d_customer"]
    assert log[SECOND].dimensions == log[SECOND].order_months == []
    assert affected(refresh, SECOND) == 0
    # One moved customer: their table is written, and their months of the report.
    moved = customers(spark, 2).withColumn("customer_address", F.lit("elsewhere"))
    report = refresh.run(wide(spark, BATCH_1), moved, THIRD)
    last = refresh.last_run()
    assert last.dimensions == {"d_craftsman": FIRST, "d_product": FIRST, "d_customer": THIRD}
    assert last.report_months == {"2023-01": THIRD, "2023-02": FIRST}
    assert {r.customer_address for r in report.collect()} == {"Road 1", "elsewhere"}
    assert [r.load_dttm for r in refresh.star().customer.orderBy("customer_id").collect()] == [
        FIRST, THIRD,
    ]


def test_a_small_delivery_reads_only_what_runs_since_the_mark_wrote(spark, tmp_path, monkeypatch):
    """Change capture of a third delivery, of one order, looks at that order's month alone."""
    refresh = Refresh(spark, str(tmp_path), exact_mark=True, only_if_changed=True)
    refresh.run(wide(spark, BATCH_1), customers(spark, 1, 2), FIRST)
    refresh.run(wide(spark, BATCH_2), customers(spark, 3), SECOND)
    seen = []
    real = changes.touched_orders

    def spy(star, mark, recent=None, among=changes.DIMENSIONS):
        seen.append((recent, tuple(among)))
        return real(star, mark, recent, among)

    monkeypatch.setattr(changes, "touched_orders", spy)
    order = [(9, 1, "Vase", "Bob", dt.date(2023, 2, 11), None, "created")]
    refresh.run(wide(spark, order), customers(spark), THIRD)
    (recent, among), = seen
    assert among == ()
    files = recent.inputFiles()
    assert files and all("month_part=2023-02" in f and THIRD.strftime("%Y%m%d") in f for f in files)
    plan = recent.where(F.col("load_dttm") > F.lit(SECOND))._jdf.queryExecution().executedPlan()
    assert "GreaterThan(load_dttm" in plan.toString()
    assert {r.customer_id for r in refresh.tables.read(
        "affected_months", "customer_id BIGINT", THIRD
    ).collect()} == {1}


def spied(monkeypatch, cls, name, note):
    real = getattr(cls, name)

    def spy(self, *args, **named):
        note(self, *args)
        return real(self, *args, **named)

    monkeypatch.setattr(cls, name, spy)


def test_a_delivery_of_one_order_measures_one_month(spark, tmp_path, monkeypatch):
    """Customer 1 has orders in two months, and the new one is in the second: the report's row of
    the first is not computed again, nor are the first month's orders read for it."""
    refresh = Refresh(spark, str(tmp_path), exact_mark=True, only_if_changed=True)
    refresh.run(wide(spark, BATCH_1), customers(spark, 1, 2), FIRST)
    measured = []
    real = changes.orders_in

    def spy(orders, months):
        measured.append((orders.inputFiles(), months.collect()))
        return real(orders, months)

    monkeypatch.setattr("tallyhouse.plans.refresh.orders_in", spy)
    order = [(9, 1, "Vase", "Bob", dt.date(2023, 2, 11), None, "created")]
    report = refresh.run(wide(spark, order), customers(spark), SECOND)
    (files, months), = measured
    assert files and all("month_part=2023-02" in f for f in files)
    assert [(r.customer_id, r.report_month) for r in months] == [(1, "2023-02")]
    assert refresh.tables.read("report_rows", "customer_id INT", SECOND).count() == 1
    counts = {(r.customer_id, r.report_month): r.customer_order_count for r in report.collect()}
    assert counts == {(1, "2023-01"): 3, (1, "2023-02"): 2, (2, "2023-01"): 2}


def test_a_moved_customer_is_described_and_not_measured(spark, tmp_path, monkeypatch):
    refresh = Refresh(spark, str(tmp_path), exact_mark=True, only_if_changed=True)
    refresh.run(wide(spark, BATCH_1), customers(spark, 1, 2), FIRST)
    before = shown(refresh.report())

    def none(orders, months):
        raise AssertionError("no order was touched")

    monkeypatch.setattr("tallyhouse.plans.refresh.orders_in", none)
    moved = customers(spark, 1).withColumn("customer_address", F.lit("elsewhere"))
    report = refresh.run(wide(spark, []), moved, SECOND)
    assert shown(report) == before
    assert sorted((r.id, r.customer_id, r.customer_address) for r in report.collect()) == [
        (1, 1, "elsewhere"), (2, 1, "elsewhere"), (3, 2, "Road 2"),
    ]
    affected_rows = refresh.tables.read(
        "affected_months", "customer_id BIGINT, measured BOOLEAN", SECOND
    ).collect()
    assert [(r.customer_id, r.measured) for r in affected_rows] == [(1, False), (1, False)]


def test_a_customer_who_appears_after_their_orders(spark, tmp_path):
    """Orders of an unknown customer are not in the report until the customer is delivered, and
    then in all their months, whichever run wrote them."""
    refresh = Refresh(spark, str(tmp_path), exact_mark=True, only_if_changed=True)
    refresh.run(wide(spark, BATCH_1), customers(spark, 1), FIRST)
    late = [(9, 2, "Rug", "Bob", dt.date(2023, 3, 3), None, "created")]
    report = refresh.run(wide(spark, late), customers(spark), SECOND)
    assert {r.customer_id for r in report.collect()} == {1}
    report = refresh.run(wide(spark, []), customers(spark, 2), THIRD)
    full = conform_report(report_rows(refresh.star()))
    rows = report.select(*full.columns)
    assert rows.exceptAll(full).isEmpty() and full.exceptAll(rows).isEmpty()
    assert {(r.customer_id, r.report_month) for r in rows.collect()} == {
        (1, "2023-01"), (1, "2023-02"), (2, "2023-01"), (2, "2023-03"),
    }


def test_checks_are_taken_while_writing(spark, tmp_path, monkeypatch):
    """A delivery writes each table's rows, changes and merged rows once. Nothing is read again for
    the checks but the ids of orders."""
    refresh = Refresh(spark, str(tmp_path), exact_mark=True, only_if_changed=True)
    refresh.run(wide(spark, BATCH_1), customers(spark, 1, 2), FIRST)
    last = refresh.last_run()
    orders, people = wide(spark, BATCH_2), customers(spark, 3)
    writes, reads = [], []
    spied(monkeypatch, type(orders.write), "parquet", lambda _, path: writes.append(path))
    for name in ("collect", "first", "count", "isEmpty"):
        spied(monkeypatch, type(orders), name, lambda frame, *_: reads.append(frame.columns))
    refresh.merge_delivery(orders, people, last, SECOND)
    tables = sorted(path.removeprefix(f"{tmp_path}/").split("/")[0] for path in writes)
    assert tables == sorted(
        [f"{t}_{k}" for t in ("d_craftsman", "d_customer", "d_product", "f_order")
         for k in ("changes", "source")] + ["d_customer", "f_order"]
    )
    assert reads == [["order_id", "row_count"]]


def test_ids_of_other_months_are_read_within_the_range_of_the_delivery(spark, tmp_path):
    refresh = Refresh(spark, str(tmp_path))
    refresh.run(wide(spark, BATCH_1), customers(spark, 1, 2), FIRST)
    taken = [(4, 2, "Rug", "Bob", dt.date(2023, 3, 3), None, "created")]
    with pytest.raises(ConstraintViolation, match="f_order: double keys.*'order_id': 4"):
        refresh.run(wide(spark, taken), customers(spark), SECOND)
    assert refresh.last_run().runs == 1


def test_two_orders_with_one_id_in_a_delivery(spark, tmp_path):
    doubled = [BATCH_1[0], (1, 2, "Rug", "Bob", dt.date(2023, 4, 3), None, "created")]
    with pytest.raises(ConstraintViolation, match="f_order: double keys.*'order_id': 1"):
        Refresh(spark, str(tmp_path)).run(wide(spark, doubled), customers(spark, 1, 2), FIRST)
