"""What the executed plans must and must not contain."""

import functools
import pathlib
import re
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402

LAZY = sorted(contract.report_queries().keys() - {"mart_incremental", "mart_incremental_exact"})


@pytest.fixture(scope="module")
def plan_of(spark):
    @functools.cache
    def plan(name):
        frame = contract.report_queries()[name](spark, contract.SMOKE_DIR)
        return frame._jdf.queryExecution().executedPlan().toString()

    return plan


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins_and_no_python(plan_of, name):
    plan = plan_of(name)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan


def test_the_report_reads_only_what_it_needs(plan_of):
    plan = plan_of("mart_full_onepass")
    lines = [s for s in plan.splitlines() if "FileScan" in s and "lineitem" in s]
    assert len(lines) == 1
    columns = set(re.findall(r"(l_\w+)#", lines[0].split("]")[0]))
    assert columns == {"l_orderkey", "l_partkey", "l_suppkey", "l_linestatus", "l_shipdate"}


def test_the_report_combines_rows_and_shuffles_orders_once(plan_of):
    """After the exchange that makes the orders there is one, by customer and month."""
    lines = plan_of("mart_full_onepass").splitlines()
    by_month = [
        i for i, s in enumerate(lines) if "hashpartitioning(customer_id" in s and "month" in s
    ]
    assert len(by_month) == 1
    assert "ObjectHashAggregate" in lines[by_month[0] + 1]
    assert "partial_percentile" in lines[by_month[0] + 1]
    assert sum("hashpartitioning(l_partkey" in s for s in lines) == 1


def test_rankings_are_cut_before_the_shuffle(plan_of):
    for name in ("top_product", "top_craftsman", "latest_craftsman"):
        assert "WindowGroupLimit" in plan_of(name)


def test_semi_and_anti_joins(plan_of):
    assert "LeftAnti" in plan_of("new_customers")
    assert "LeftSemi" in plan_of("affected_history")
    for name in ("merge_craftsman", "merge_product", "merge_customer", "merge_order"):
        plan = plan_of(name)
        assert "LeftAnti" in plan and "LeftSemi" in plan and "FullOuter" not in plan


def test_nothing_is_brought_into_one_task(plan_of):
    """But for aggregates that give one row, and the sizes of the blocks of ids. The words of a key
    filter, a fixed number, are such an aggregate."""
    one_row = {"hwm_read", "hwm_next", "check_not_null"}
    for name in LAZY:
        plan = plan_of(name)
        alone = plan.count("Exchange SinglePartition") - plan.count("[partial_collect_list(entry")
        assert alone == (1 if name in one_row | {"mart_ids"} else 0), name


@pytest.mark.parametrize("name", ["mart_full_onepass", "mart_full", "mart_ids"])
def test_the_executed_report_reads_the_lines_once(spark, name):
    """Without broadcasts, as dimensions are that outgrow the threshold."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = contract.report_queries()[name](spark, contract.SMOKE_DIR)
        frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    final = plan.split("== Initial Plan ==")[0]
    scans = [s for s in final.splitlines() if "FileScan" in s and "lineitem" in s]
    assert len(scans) == 1
    assert "CartesianProduct" not in final and "BroadcastNestedLoopJoin" not in final


def test_no_shuffle_carries_the_widest_attributes(spark):
    """Without broadcasts, the customer joins the orders last, and the craftsman the wide source."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, key in (("star_join", "customer_id"), ("distinct_craftsman", "craftsman_id")):
            frame = contract.report_queries()[name](spark, contract.SMOKE_DIR)
            plan = frame._jdf.queryExecution().executedPlan().toString()
            joins = [s for s in plan.splitlines() if "SortMergeJoin" in s]
            assert f"{key}#" in joins[0].split("],")[0], name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_update_shuffles_few_lines_by_their_key(plan_of):
    """Only those of orders that share customer and day with another, in either report."""
    plan = plan_of("mart_update")
    by_key = sum("hashpartitioning(l_partkey" in s for s in plan.splitlines())
    assert by_key == len(re.findall(r"Filter .*NOT \(__of_day", plan)) == 2


def test_the_update_makes_both_reports_of_one_shuffle_of_the_lines(spark):
    """Without broadcasts. After an order has its names it is shuffled once, by customer, and the
    folded rows once, for the update."""
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    try:
        frame = contract.report_queries()["mart_update"](spark, contract.SMOKE_DIR)
        plan = frame._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    made = [s for s in plan.splitlines() if "Exchange" in s and "ReusedExchange" not in s]
    assert sum("hashpartitioning(l_orderkey" in s for s in made) == 1
    assert not any("hashpartitioning(customer_id" in s and "month" in s for s in made)
    # Orders of either report, the customers of either, and those of the source orders.
    assert sum("hashpartitioning(customer_id#" in s for s in made) == 5
