import datetime as dt

from tallyhouse.operators.upsert import changed_rows, latest_per_key, overwrite, upsert

OLD, NOW = dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2, 12)
SCHEMA = "id BIGINT, name STRING, mail STRING, city STRING, load_dttm TIMESTAMP_NTZ"


def table(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def merged(target, source, **options):
    result = upsert(target, source, ["name", "mail"], ["id", "city"], NOW, **options)
    assert result.columns == target.columns
    return {tuple(r) for r in result.collect()}


def test_overwrites_adds_and_keeps(spark):
    target = table(spark, (1, "a", "x", "here", OLD), (2, "b", "x", "here", None))
    source = table(spark, (7, "a", "x", "there", None), (8, "a", "y", "new", None))
    assert merged(target, source) == {
        (7, "a", "x", "there", NOW),
        (2, "b", "x", "here", None),
        (8, "a", "y", "new", NOW),
    }


def test_a_null_key_matches_nothing(spark):
    target = table(spark, (1, None, "x", "here", OLD))
    source = table(spark, (1, None, "x", "there", None))
    assert merged(target, source) == {
        (1, None, "x", "here", OLD),
        (1, None, "x", "there", NOW),
    }
    assert merged(target, source, null_safe=True) == {(1, None, "x", "there", NOW)}


def test_unchanged_rows_are_touched_unless_told_otherwise(spark):
    target = table(spark, (1, "a", "x", None, OLD), (2, "b", "x", "here", OLD))
    source = table(spark, (1, "a", "x", None, None), (2, "b", "x", None, None))
    assert {r[4] for r in merged(target, source)} == {NOW}
    assert merged(target, source, only_if_changed=True) == {
        (1, "a", "x", None, OLD),
        (2, "b", "x", None, NOW),
    }


def test_all_target_rows_with_the_key_are_overwritten(spark):
    target = table(spark, *[(i, "a", "x", "here", OLD) for i in range(50)])
    source = table(spark, (99, "a", "x", "there", None))
    result = upsert(target, source, ["name", "mail"], ["city"], NOW).collect()
    assert sorted(r.id for r in result) == list(range(50))
    assert {r.city for r in result} == {"there"}


def test_empty_sides(spark):
    some, none = table(spark, (1, "a", "x", "here", None)), table(spark)
    assert merged(none, some) == {(1, "a", "x", "here", NOW)}
    assert merged(some, none) == {(1, "a", "x", "here", None)}


def test_merging_a_table_with_itself(spark):
    target = table(spark, (1, "a", "x", "here", OLD), (2, "b", "x", "here", OLD))
    assert merged(target, target) == {(1, "a", "x", "here", NOW), (2, "b", "x", "here", NOW)}


def test_overwrite_adds_nothing(spark):
    target = table(spark, (1, "a", "x", "here", OLD))
    source = table(spark, (5, "a", "x", None, None), (6, "c", "x", "new", None))
    result = overwrite(target, source, ["name", "mail"], ["city"]).collect()
    assert [tuple(r) for r in result] == [(1, "a", "x", None, OLD)]


def test_changed_rows(spark):
    schema = "k INT, m STRING, v INT, w STRING"
    before = spark.createDataFrame(
        [(1, "a", 1, None), (2, "a", 2, "x"), (3, None, 3, "x"), (4, "a", 4, "x")], schema
    )
    rows = spark.createDataFrame(
        [(1, "a", 1, None), (2, "a", 2, None), (3, None, 3, "x"), (5, None, 5, "x")], schema
    )
    def found(**options):
        return sorted(r.k for r in changed_rows(rows, before, ["k", "m"], **options).collect())

    assert found(null_safe=True) == [2, 5]
    assert found() == [2, 3, 5]
    # A key that is there twice with other values gives its row once.
    assert sorted(
        r.k for r in changed_rows(rows, before.unionAll(before), ["k", "m"]).collect()
    ) == [2, 3, 5]


def test_latest_per_key(spark):
    source = table(
        spark,
        (1, "a", "x", "old", OLD),
        (1, "a", "x", "new", NOW),
        (1, "a", "x", "never", None),
        (2, "b", "x", "tie b", NOW),
        (2, "b", "x", "tie a", NOW),
    )
    found = latest_per_key(source, ["name", "mail"], by="load_dttm").collect()
    assert {(r.name, r.city) for r in found} == {("a", "new"), ("b", "tie a")}
