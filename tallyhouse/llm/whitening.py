"""Whitening of embeddings by principal components from an exact characteristic polynomial.

Entries become integers, x = floor(1024 * c) + 100000. Tasks add up the vectors and their products
exactly; the sums of all tasks give the integer scatter A = n * sum(x x') - S S', which is n * n
times the covariance. From there on the work depends on the dimension only:

- The characteristic polynomial of A modulo a prime comes from a similar Hessenberg matrix. Spark
  deals as many primes to tasks as a bound on the coefficients asks for, and Chinese remaindering
  puts the residues together to the exact integer polynomial.
- A is symmetric, so all roots are real, and Descartes' rule is exact: the number of roots above t
  is the number of sign changes in the coefficients of p(x + t). Bisection in integers, scaled by a
  power of two, isolates each of the largest roots to well below double precision, repeated roots
  included.
- The null space of A - root * I is found by inverse iteration; vectors of equal or close roots are
  made orthogonal to the ones before.

Rows are then projected in a second pass, and the covariance of the whitened rows is measured in a
third, centred, over all of them.

Edge cases: rows whose vector is null, empty or holds null or non-finite entries are dropped; of
vectors of several lengths the most frequent length stays (the smaller if tied). An entry of 2**42
or more in amount is an error, as its integer is not exact. Components without variance are left
out, so constant vectors give no rows. A deviation that exceeds a long is an error. Repeated and
null vec_ids are rows like any other. An empty table gives an empty result. Extra columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from functools import reduce
from math import comb, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Components of the result; what an entry is multiplied by, and what is added to it.
COMPONENTS, SCALE, SHIFT = 8, 1024, 100_000
#: Bits of a root beyond the bits of the largest integer below it that double precision needs.
ROOT_BITS = 80
_LARGEST_ENTRY = 2.0**42
_EXACT = 2**53


def vectors(batch: pa.RecordBatch, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """The integers x - 100000 of the batch's valid vectors, and which rows these are."""
    column = batch.column("vector")
    lengths = column.value_lengths().fill_null(0).to_numpy()
    right = np.flatnonzero(lengths == dimension)
    flat = column.take(pa.array(right)).flatten().cast(pa.float64())
    values = flat.to_numpy(zero_copy_only=False).reshape(-1, dimension)
    valid = np.isfinite(values).all(axis=1)
    if flat.null_count:
        nulls = flat.is_null().to_numpy(zero_copy_only=False).reshape(-1, dimension)
        valid &= ~nulls.any(axis=1)
    values = values[valid]
    if (np.abs(values) >= _LARGEST_ENTRY).any():
        raise ValueError("an entry of a vector is too large to be made an exact integer")
    return np.floor(values * SCALE).astype(np.int64), right[valid]


def _products(x: np.ndarray) -> np.ndarray:
    """The sum of the products of every two entries, exact, as Python's integers."""
    out = np.zeros((x.shape[1], x.shape[1]), dtype=object)
    largest = int(np.abs(x).max(initial=1))
    rows = _EXACT // max(1, largest**2)
    if rows < 1:
        wide = x.astype(object)
        return wide.T @ wide
    for start in range(0, len(x), rows):
        some = x[start : start + rows].astype(np.float64)
        out += (some.T @ some).astype(np.int64).astype(object)
    return out


@dataclass
class Scatter:
    """How many vectors there are, the sum of x - 100000 in each dimension, and the scatter."""

    n: int
    sums: list[int]
    matrix: list[list[int]]

    @classmethod
    def of(cls, rows: DataFrame, dimension: int) -> Scatter:
        """From one pass over all rows; tasks hand on a sum for every two dimensions."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            count, sums = 0, np.zeros(dimension, dtype=object)
            products = np.zeros((dimension, dimension), dtype=object)
            for batch in batches:
                x, _ = vectors(batch, dimension)
                count += len(x)
                sums += x.astype(object).sum(axis=0) if len(x) else 0
                products += _products(x)
            lower = [(i, j) for i in range(dimension) for j in range(i + 1)]
            found = [(-1, -1, count), *((i, -1, s) for i, s in enumerate(sums))]
            found += [(i, j, products[i, j]) for i, j in lower]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([f[0] for f in found], pa.int32()),
                    pa.array([f[1] for f in found], pa.int32()),
                    pa.array([str(f[2]) for f in found], pa.string()),
                ],
                names=["i", "j", "part"],
            )

        total = F.sum(F.col("part").cast("decimal(38,0)")).alias("total")
        found = rows.mapInArrow(run, "i int, j int, part string").groupBy("i", "j").agg(total)
        sums = {(r["i"], r["j"]): int(r["total"]) for r in found.collect()}
        n = sums.get((-1, -1), 0)
        s = [sums.get((i, -1), 0) for i in range(dimension)]
        matrix = [
            [n * sums.get((max(i, j), min(i, j)), 0) - s[i] * s[j] for j in range(dimension)]
            for i in range(dimension)
        ]
        return cls(n, s, matrix)


def primes(count: int, below: int = 2**31) -> list[int]:
    """The largest primes below a bound."""
    out: list[int] = []
    number = below - 1
    divisors = np.arange(3, isqrt(below) + 1, 2)
    while len(out) < count:
        if number % 2 and (number % divisors).all():
            out.append(number)
        number -= 1
    return out


def polynomial_modulo(matrix: list[list[int]], prime: int) -> list[int]:
    """Coefficients of det(x I - A) modulo a prime below 2**31, constant first: A is made similar
    to a Hessenberg matrix, whose leading blocks have polynomials that follow from each other."""
    d = len(matrix)
    h = np.array([[int(v) % prime for v in row] for row in matrix], dtype=np.int64).reshape(d, d)
    for k in range(1, d - 1):
        below = np.flatnonzero(h[k:, k - 1])
        if not len(below):
            continue
        pivot = k + int(below[0])
        if pivot != k:
            h[[k, pivot]] = h[[pivot, k]]
            h[:, [k, pivot]] = h[:, [pivot, k]]
        factor = h[k + 1 :, k - 1] * pow(int(h[k, k - 1]), -1, prime) % prime
        h[k + 1 :] = (h[k + 1 :] - factor[:, None] * h[k] % prime) % prime
        # Factors are below 2**31: a product fits a long, a sum of products is reduced on the way.
        h[:, k] = (h[:, k] + (h[:, k + 1 :] * factor % prime).sum(axis=1)) % prime
    polynomials = np.zeros((d + 1, d + 1), dtype=np.int64)
    polynomials[0, 0] = 1
    for k in range(1, d + 1):
        last = polynomials[k - 1]
        now = np.concatenate(([0], last[:-1])) - int(h[k - 1, k - 1]) * last % prime
        chain = 1
        for i in range(1, k):
            chain = chain * int(h[k - i, k - i - 1]) % prime
            if not chain:
                break
            now = now - int(h[k - i - 1, k - 1]) * chain % prime * polynomials[k - i - 1] % prime
        polynomials[k] = now % prime
    return polynomials[d].tolist()


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """The exact coefficients of det(x I - A) for a positive semidefinite A, constant first.

    Coefficient k is a sum of products of eigenvalues, at most C(d, k) (trace / d)**k."""
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    bound = max(comb(d, k) * (trace // d + 1) ** k for k in range(d + 1))
    moduli = primes(2 + (2 * bound).bit_length() // 30)
    sent = spark.sparkContext.broadcast(matrix)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.column("prime").to_pylist()
            found = [polynomial_modulo(sent.value, p) for p in some]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int64()), pa.array(found, pa.list_(pa.int64()))],
                names=["prime", "residues"],
            )

    tasks = min(len(moduli), spark.sparkContext.defaultParallelism)
    dealt = spark.createDataFrame([(p,) for p in moduli], "prime long").repartition(tasks)
    found = dealt.mapInArrow(run, "prime long, residues array<long>").collect()
    whole = reduce(lambda a, b: a * b, moduli)
    values = [0] * (d + 1)
    for row in found:
        rest = whole // row["prime"]
        factor = rest * pow(rest, -1, row["prime"])
        for k, residue in enumerate(row["residues"]):
            values[k] += residue * factor
    values = [v % whole for v in values]
    return [v - whole if 2 * v > whole else v for v in values]


def roots_above(polynomial: list[int], t: int) -> int:
    """How many roots, counted as often as they are repeated, lie above t. All must be real."""
    shifted = list(polynomial)
    for start in range(len(shifted) - 1):
        for k in range(len(shifted) - 2, start - 1, -1):
            shifted[k] += t * shifted[k + 1]
    signs = [c > 0 for c in shifted if c]
    return sum(a != b for a, b in zip(signs[:-1], signs[1:], strict=True))


def largest_roots(polynomial: list[int], count: int, bits: int = ROOT_BITS) -> list[Fraction]:
    """The largest roots in falling order, repeated ones repeatedly, of a polynomial with integer
    coefficients and real roots that are not negative. Each is within 2**-bits of its amount."""
    d = len(polynomial) - 1
    # The roots add up to the second coefficient; enough bits for a root of this size.
    size = max(0, -polynomial[d - 1]) if d else 0
    count = min(count, next((d - k for k, c in enumerate(polynomial) if c), 0))
    scale = bits + max(0, 8 - size.bit_length())
    known: dict[int, int] = {}

    def above(t: int, power: int) -> int:
        """Roots above t / 2**power."""
        key = t << (scale - power)
        if key not in known:
            scaled = [c << (power * (d - k)) for k, c in enumerate(polynomial)]
            known[key] = roots_above(scaled, t)
        return known[key]

    out = []
    for k in range(1, count + 1):
        low, high, power = 0, size + 1, 0
        while True:
            while high - low > 1:
                middle = (low + high) // 2
                if above(middle, power) >= k:
                    low = middle
                else:
                    high = middle
            if low.bit_length() >= bits or power >= scale:
                break
            step = min(scale - power, max(1, bits - low.bit_length()))
            low, high, power = low << step, high << step, power + step
        out.append(Fraction(2 * low + 1, 2 ** (power + 1)))
    return out


def null_vectors(matrix: np.ndarray, roots: np.ndarray, rounds: int = 6) -> np.ndarray:
    """A unit vector for each root, by inverse iteration, each orthogonal to the ones before."""
    d = len(matrix)
    out = np.zeros((0, d))
    eye = np.eye(d)
    for number, root in enumerate(roots):
        # A little off the root, or the matrix could have no inverse at all.
        gap = matrix - (root + 4 * np.finfo(float).eps * np.abs(matrix).sum(axis=1).max()) * eye
        v = np.cos(np.arange(1, d + 1) * (number + 1.0))
        for _ in range(rounds):
            for _ in range(2):
                v = v - out.T @ (out @ v)
            v = np.linalg.solve(gap, v / np.linalg.norm(v))
            v = v / np.linalg.norm(v)
        for _ in range(2):
            v = v - out.T @ (out @ v)
            v = v / np.linalg.norm(v)
        out = np.vstack((out, v))
    return out


@dataclass
class Whitening:
    """Everything that a task needs to whiten vectors."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    explained: np.ndarray

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S for each vector, exact."""
        largest = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0)
        kind = np.int64 if largest < 2**63 else object
        return x.astype(kind) * self.n - np.array(self.sums, dtype=kind)

    def whitened(self, deviations: np.ndarray) -> np.ndarray:
        centred = deviations.astype(np.float64) / self.n
        return centred @ self.components.T / np.sqrt(self.variances)


def fit(rows: DataFrame, dimension: int, components: int = COMPONENTS) -> Whitening:
    """The whitening of all rows."""
    scatter = Scatter.of(rows, dimension)
    matrix, n = scatter.matrix, scatter.n
    trace = sum(matrix[i][i] for i in range(dimension))
    if not trace:
        none = np.zeros(0)
        return Whitening(n, scatter.sums, np.zeros((0, dimension)), none, none)
    polynomial = characteristic_polynomial(rows.sparkSession, matrix)
    roots = largest_roots(polynomial, components)
    relative = np.array([[float(Fraction(v, trace)) for v in row] for row in matrix])
    shares = np.array([float(r / trace) for r in roots])
    found = null_vectors(relative, shares)
    variances = np.array([float(r / (n * n)) for r in roots])
    return Whitening(n, scatter.sums, found, variances, shares)


def squares(deviations: np.ndarray) -> list[int]:
    """The exact sum of the squares of each row."""
    largest = int(np.abs(deviations).max(initial=0))
    if largest**2 * deviations.shape[1] < 2**63:
        return (deviations.astype(np.int64) ** 2).sum(axis=1).tolist()
    return [sum(int(v) ** 2 for v in row) for row in deviations]


def projected(rows: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation and the whitened vector of each valid row."""
    sent = rows.sparkSession.sparkContext.broadcast(model)
    dimension = len(model.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            x, right = vectors(batch, dimension)
            deviations = model.deviations(x)
            values = model.whitened(deviations)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(right)),
                    pa.array(squares(deviations), pa.int64()),
                    pa.FixedSizeListArray.from_arrays(
                        pa.array(values.ravel()), values.shape[1]
                    ).cast(pa.list_(pa.float64())),
                ],
                names=["vec_id", "deviation", "whitened"],
            )

    return rows.mapInArrow(run, "vec_id long, deviation long, whitened array<double>")


def identity_error(white: DataFrame, components: int) -> float:
    """The largest entry, in amount, of the whitened rows' covariance minus the identity."""
    parts = [F.col("whitened")[i] for i in range(components)]
    pairs = [(i, j) for i in range(components) for j in range(i + 1)]
    row = white.agg(*[F.covar_pop(parts[i], parts[j]) for i, j in pairs]).first()
    return max(abs(value - (i == j)) for value, (i, j) in zip(row, pairs, strict=True))


def most_frequent_length(rows: DataFrame) -> int:
    """The length that most valid vectors have, the smallest of several; 0 if there is none."""
    valid = F.size("vector") > 0
    valid &= F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    sizes = rows.where(valid).groupBy(F.size("vector").alias("size")).count()
    first = sizes.orderBy(F.col("count").desc(), "size").first()
    return first["size"] if first else 0


def whiten(
    embeddings: DataFrame, vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained and identity_error, a row for
    each valid vector and component."""
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col(vector).cast("array<double>").alias("vector"),
    )
    schema = (
        "vec_id long, component int, n long, deviation long, whitened double, explained double, "
        "identity_error double"
    )
    dimension = most_frequent_length(rows)
    model = fit(rows, dimension, components) if dimension else None
    if model is None or not len(model.components):
        return rows.sparkSession.createDataFrame([], schema)
    white = projected(rows, model)
    error = identity_error(white, len(model.components))
    explained = F.array(*[F.lit(float(e)) for e in model.explained])
    return white.select(
        "vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")
    ).select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained[F.col("place")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )
