"""The filter over touched keys: what it lets through, and where it stands in the plan."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions.columns import moment
from tallyhouse.operators import changes
from tallyhouse.operators.key_filter import key_filter, may_hold
from tallyhouse.operators.star import Star
from tallyhouse.sources.marketplace import Marketplace

DATA = "/root/testdata/sf0.001"
MARK, LATER = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


@pytest.mark.parametrize("count", [0, 1, 3_000])
def test_no_key_is_lost_and_few_others_pass(spark, count):
    keys = spark.range(count).select((F.col("id") * 7).alias("k"))
    others = spark.range(100_000).select((-1 - F.col("id")).alias("k"))
    words = key_filter(keys.unionByName(spark.createDataFrame([(None,)], "k long")))
    assert keys.where(~may_hold(words, F.col("k"))).isEmpty()
    assert others.where(may_hold(words, F.col("k"))).count() <= 100
    nothing = spark.createDataFrame([(None,)], "k long")
    assert nothing.where(may_hold(words, F.col("k"))).isEmpty()


def test_a_full_filter_lets_all_through(spark):
    keys = spark.range(5_000).toDF("k")
    words = key_filter(keys, bits=256)
    assert spark.range(10_000).where(may_hold(words, F.col("id"), bits=256)).count() == 10_000


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    """A stored star of which one craftsman was touched and nothing else."""
    market, root = Marketplace(spark, DATA).star(), tmp_path_factory.mktemp("star")
    one = F.col("craftsman_id") == 3
    tables = {
        "craftsman": spark.range(100).toDF("craftsman_id").withColumn(
            "load_dttm", F.when(one, moment(LATER)).otherwise(moment(MARK))
        ),
        "product": market.product.withColumn("load_dttm", moment(MARK)),
        "customer": market.customer.withColumn("load_dttm", moment(MARK)),
        # Spread over a hundred craftsmen.
        "order": market.order.withColumn("load_dttm", moment(MARK)).withColumn(
            "order_craftsman_id", F.pmod(F.xxhash64("order_id"), F.lit(100))
        ),
    }
    for name, table in tables.items():
        table.write.parquet(f"{root}/{name}")
    return Star(**{name: spark.read.parquet(f"{root}/{name}") for name in tables})


def test_the_orders_are_cut_below_the_exchange(spark, star):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = changes.touched_orders(star, MARK)
        assert found.collect()
        plan = found._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    final = plan.toString().split("== Initial Plan ==")[0]
    assert re.search(
        r"Exchange hashpartitioning\(order_craftsman_id[^\n]*\n[^\n]*Filter [^\n]*getbit\(", final
    )


def test_one_craftsman_of_a_hundred_shuffles_few_orders(spark, star):
    words = key_filter(changes.touched(star.craftsman, MARK).select("craftsman_id"))
    whole = star.order.count()
    kept = star.order.where(may_hold(words, F.col("order_craftsman_id"))).count()
    touched = changes.touched_orders(star, MARK).count()
    assert 0 < touched <= kept < 0.05 * whole
    assert touched == star.order.where("order_craftsman_id = 3").count()
