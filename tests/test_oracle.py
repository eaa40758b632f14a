"""Every registered query against the same SQL in DuckDB, at the smallest scale."""

import math
import pathlib
import sys

import duckdb
import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
import oracle  # noqa: E402

DATA = pathlib.Path(contract.SMOKE_DIR)
QUERIES = contract.report_queries()
SQL = oracle.statements()

# Queries for which an empty result would check nothing.
MAY_BE_EMPTY: set[str] = set()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS FROM '{table}'")
    return connection


def test_every_query_has_sql():
    assert SQL.keys() == QUERIES.keys()


def normal(value):
    if isinstance(value, float):
        return "null" if math.isnan(value) else repr(value)
    return "null" if value is None else f"{type(value).__name__}:{value}"


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows(spark, duck, name):
    frame = QUERIES[name](spark, str(DATA))
    order = sorted(frame.columns)
    ours = sorted(tuple(normal(row[c]) for c in order) for row in frame.collect())
    found = duck.execute(SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == order
    theirs = sorted(
        tuple(normal(row[names.index(c)]) for c in order) for row in found.fetchall()
    )
    assert ours == theirs
    assert ours or name in MAY_BE_EMPTY
