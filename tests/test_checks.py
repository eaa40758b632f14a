import pytest

from tallyhouse.operators.checks import (
    ConstraintViolation,
    check_merge_cardinality,
    check_not_null,
    check_pk,
    refuse,
)


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [(1, "a", None), (1, "b", "x"), (2, "c", None), (3, "d", "x"), (3, "d", "x")],
        "id BIGINT, name STRING, note STRING",
    )


def found(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_primary_key(spark, rows):
    assert found(check_pk(rows, ["id"])) == [(1, 2), (3, 2)]
    assert found(check_pk(rows, ["id", "name"])) == [(3, "d", 2)]
    batch = spark.createDataFrame([(3,), (3,), (9,)], "id BIGINT")
    assert found(check_pk(rows, ["id"], among=batch)) == [(3, 2)]


def test_required_columns(rows):
    assert found(check_not_null(rows, ["id", "name", "note"])) == [("note", 2)]
    assert found(check_not_null(rows.limit(0), ["id", "note"])) == []


def test_merge_cardinality(spark, rows):
    target = spark.createDataFrame([("b",), ("d",)], "name STRING")
    source = rows.unionByName(
        spark.createDataFrame([(4, "c", None), (5, None, None), (6, None, None)], rows.schema)
    )
    # "c" is double in the source but not in the target; NULL matches nothing.
    assert found(check_merge_cardinality(target, source, ["name"])) == [("d", 2)]


def test_refuse(rows):
    refuse(check_pk(rows.where("id = 2"), ["id"]), "fine")
    with pytest.raises(ConstraintViolation, match="twice.*'id': 3"):
        refuse(check_pk(rows.where("id = 3"), ["id"]), "twice")
