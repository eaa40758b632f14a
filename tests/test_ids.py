import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.ids import with_row_ids


@pytest.mark.parametrize("kind, spread", [("int", 70_001), ("bigint", 3_000_000_000_017)])
def test_ids_are_consecutive_in_key_order(spark, kind, spread):
    keys = spark.range(300).select(
        ((F.col("id") - 150) * F.lit(spread) % F.lit(2**31 if kind == "int" else 2**62))
        .cast(kind)
        .alias("customer_id")
    )
    months = F.explode(F.array(F.lit("2020-02"), F.lit(None), F.lit("2020-01")))
    rows = keys.distinct().select("customer_id", months.alias("report_month"))
    numbered = with_row_ids(rows.repartition(7), "customer_id", ["report_month"], after=40)
    found = numbered.orderBy("id").collect()
    assert [r.id for r in found] == list(range(41, 41 + len(found)))
    assert len(found) == 900
    order = [(r.customer_id, r.report_month is None, r.report_month or "") for r in found]
    assert order == sorted(order)


def test_no_rows(spark):
    empty = spark.createDataFrame([], "customer_id INT, report_month STRING")
    assert with_row_ids(empty, "customer_id", ["report_month"]).count() == 0


def test_ids_do_not_depend_on_the_size_of_blocks(spark):
    rows = spark.range(3_000).select(
        (F.col("id") * 7919 % 1000 - 500).cast("int").alias("k"), (F.col("id") % 3).alias("m")
    ).distinct()
    order = {tuple(r): n for n, r in enumerate(sorted(map(tuple, rows.collect())), 1)}
    for bits in (0, 3, 16):
        made = with_row_ids(rows, "k", ["m"], block_bits=bits)
        assert {(r.k, r.m): r.id for r in made.collect()} == order


def test_many_tasks_number_the_rows(spark):
    """The 15,000 customers of the largest given tables are numbered by as many tasks as there are
    partitions. Broadcasts are off, or the rows could be sent to where the sizes are."""
    many = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {name: spark.conf.get(name) for name in many}
    for name, value in many.items():
        spark.conf.set(name, value)
    try:
        customers = spark.read.parquet("/root/testdata/sf0.1/customer.parquet")
        rows = customers.select("c_custkey").withColumn("m", F.lit(1))
        made = with_row_ids(rows, "c_custkey", ["m"])
        tasks = made.groupBy(F.spark_partition_id().alias("task")).count().collect()
        assert len(tasks) >= 8 and max(t["count"] for t in tasks) < 3_000
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@pytest.mark.parametrize("kind", ["int", "bigint"])
def test_rows_are_computed_once(spark, kind):
    """The sizes of blocks and the numbers come from one exchange of the rows."""
    made = spark.range(1_000).select((F.col("id") % 300).cast(kind).alias("k"), "id")
    rows = made.join(spark.range(300).withColumnRenamed("id", "j"), F.col("k") == F.col("j"))
    changed = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in changed}
    try:
        for name, value in changed.items():
            spark.conf.set(name, value)
        plan = with_row_ids(rows, "k", ["id"])._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert plan.count("Range (0, 1000") == 1
