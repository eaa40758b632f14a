from fractions import Fraction

import numpy as np
import pytest

from .helpers import SMALL, rows_of

from tallyhouse.llm import whitening as op
from tallyhouse.llm.shared import table

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(values):
    """n, deviations, whitened (up to signs) and explained by NumPy and plain integers."""
    x = np.floor(np.asarray(values, dtype=np.float64) * 1024).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    deviations = [sum(int(n * v - s) ** 2 for v, s in zip(r, sums, strict=True)) for r in x]
    centred = x - x.mean(axis=0)
    variances, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-variances)[:8]
    order = order[variances[order] > 1e-9 * variances.max()]
    white = centred @ vectors[:, order] / np.sqrt(variances[order])
    return deviations, white, variances[order] / variances.sum()


def hold(found, ids, values):
    deviations, white, explained = expected(values)
    rows = {(r["vec_id"], r["component"]): r for r in found}
    assert len(rows) == len(found) == white.size
    for k in range(white.shape[1]):
        ours = np.array([rows[i, k + 1]["whitened"] for i in ids])
        sign = np.sign(ours @ white[:, k])
        assert np.allclose(ours, sign * white[:, k], atol=1e-6)
    for i, deviation in zip(ids, deviations, strict=True):
        for k, share in enumerate(explained, 1):
            row = rows[i, k]
            assert (row["n"], row["deviation"]) == (len(values), deviation)
            assert abs(row["explained"] - share) <= 1e-9 * share
    assert {r["identity_error"] for r in found} == {found[0]["identity_error"]}
    assert found[0]["identity_error"] < 1e-9


def test_same_as_numpy(spark):
    rows = table(spark, SMALL, "embeddings")
    given = rows.select("vec_id", "embedding").collect()
    found = rows_of(op.whiten(rows.repartition(3)))
    hold(found, [r["vec_id"] for r in given], [r["embedding"] for r in given])


def test_odd_rows_are_dropped(spark):
    values = np.random.default_rng(3).normal(size=(40, 3)).astype(np.float32).tolist()
    good = [(i, v, 0) for i, v in enumerate(values)]
    odd = [
        (101, None, 0),
        (102, [], 0),
        (103, [0.5, None, 0.5], 0),
        (104, [0.5, float("nan"), 0.5], 0),
        (105, [float("inf"), 0.0, 0.5], 0),
        (106, [0.5, 0.5], 0),
    ]
    rows = spark.createDataFrame(good + odd, SCHEMA)
    extra = rows.selectExpr("*", "'x' AS vector", "1 AS n", "2 AS component", "3 AS whitened")
    for given in (rows, extra):
        hold(rows_of(op.whiten(given)), list(range(40)), values)


def test_repeated_and_null_ids_are_rows(spark):
    rows = spark.createDataFrame(
        [(1, [0.0, 1.0], 0), (1, [0.0, 1.0], 0), (None, [1.0, 0.5], 0), (2, [3.0, 0.0], 0)], SCHEMA
    )
    found = rows_of(op.whiten(rows))
    assert len(found) == 8 and {r["n"] for r in found} == {4}


def test_without_variance(spark):
    """Constant vectors have no component, nor does a dimension that never changes."""
    rows = spark.createDataFrame([(i, [0.25, 0.5], 0) for i in range(5)], SCHEMA)
    assert op.whiten(rows).collect() == []
    assert op.whiten(rows.limit(1)).collect() == []
    assert op.whiten(rows.limit(0)).collect() == []
    line = spark.createDataFrame([(i, [0.5 * i, 0.5, i / 4], 0) for i in range(5)], SCHEMA)
    found = rows_of(op.whiten(line))
    assert {r["component"] for r in found} == {1}
    assert all(abs(r["explained"] - 1) < 1e-12 for r in found)


def test_equal_roots(spark):
    """A circle of points has one root twice."""
    points = [(1, 0, 0), (-1, 0, 0), (0, 1, 0), (0, -1, 0), (0, 0, 0.5), (0, 0, -0.5)]
    given = [(i, [float(c) for c in p], 0) for i, p in enumerate(points)]
    rows = spark.createDataFrame(given, SCHEMA)
    found = rows_of(op.whiten(rows))
    assert len(found) == 18 and found[0]["identity_error"] < 1e-9


def test_large_entries(spark):
    """Products beyond 2**53 are added up exactly; a deviation beyond a long is refused, and so is
    an entry whose integer would not be exact."""
    x = np.array([[2**40 + 1, 3], [5, 2**33 + 7], [-(2**39) - 3, 1]])
    assert op._products(x).tolist() == (x.astype(object).T @ x.astype(object)).tolist()
    for value in (2.0**30, 2.0**42):
        rows = spark.createDataFrame([(1, [value, 0.0], 0), (2, [0.0, 1.0], 0)], SCHEMA)
        with pytest.raises(Exception, match="too large|OverflowError|ArrowInvalid|out of bounds"):
            op.whiten(rows).collect()


def test_polynomial_and_roots(spark):
    matrix = [[2, 1, 0, 0], [1, 3, 1, 0], [0, 1, 4, 0], [0, 0, 0, 0]]
    polynomial = op.characteristic_polynomial(spark, matrix)
    assert polynomial == [0, -18, 24, -9, 1]
    assert [op.roots_above(polynomial, t) for t in (-1, 0, 1, 2, 3, 5)] == [4, 3, 3, 2, 1, 0]
    roots = op.largest_roots(polynomial, 8)
    assert np.allclose([float(r) for r in roots], [3 + 3**0.5, 3, 3 - 3**0.5], rtol=1e-15)
    assert abs(roots[1] - 3) < Fraction(1, 2**70)
    rank_one = [[a * b for b in (10**9, 3, 7)] for a in (10**9, 3, 7)]
    assert op.characteristic_polynomial(spark, rank_one) == [0, 0, -(10**18) - 58, 1]
    # A zero below the diagonal, and equal rows, need other pivots.
    other = [[1, 0, 1], [0, 2, 0], [1, 0, 1]]
    assert op.characteristic_polynomial(spark, other) == [0, 4, -4, 1]
    assert [float(r) for r in op.largest_roots([0, 4, -4, 1], 3)] == [2.0, 2.0]
