"""Whitening of embeddings by the exact characteristic polynomial of their integer scatter.

Every entry c becomes the integer x = floor(64 * c) + 1000000.  Over the distinct x vectors, of which there are n, the
tasks add up exact sums S and products P; the scatter n*P - S*S' is an integer matrix, n*n times the covariance.  Its
characteristic polynomial is found modulo many primes, one Hessenberg reduction each, and put together by Chinese
remaindering: the coefficients are exact.  All roots of it are real, so the sign changes after a shift by a number count
the roots above that number exactly (Descartes), equal roots included; bisection finds the k-th largest root to 160
bits.  Inverse iteration with 100 digits then gives the null space at each root.  Primes, roots and null spaces are Spark
tasks of their own; the driver holds the d x d scatter, the coefficients and the components only.

Defined cases: rows whose vector is null, empty or holds null or non-finite entries are left out, as are rows whose
vector has another length than most distinct vectors (of equally common lengths the longer one counts).  Repeated rows
and repeated vectors are all answered, and fitted once.  Entries beyond 2**62 after scaling stand at that bound; sums stay
exact whatever their size, and a deviation that no long can hold is null.  Components with an eigenvalue of zero cannot be
whitened and are not returned, so one distinct vector, or none, gives no rows.  Equal eigenvalues give an orthonormal
basis of their space.  A null id is kept; columns other than the id and the vector are left behind.
"""

from __future__ import annotations

import decimal
from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from martlens.llm.common import prepare, stored

SCALE, SHIFT, LARGEST = 64, 1_000_000, 2**62
#: Relative bits of a root, and decimal digits of the null spaces.
ROOT_BITS, DIGITS = 160, 100
#: Vectors whose products are added up at a time.
BLOCK = 4096


class Model(NamedTuple):
    n: int
    sums: list[int]  # of x - SHIFT, by dimension
    components: np.ndarray  # one row each, by falling eigenvalue
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float


def entries(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, y): the usable vectors as whole numbers x - SHIFT; the shift falls out of everything that is returned."""

    def usable(c):
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))

    def whole(c):
        return F.greatest(F.least(F.floor(SCALE * c), F.lit(LARGEST)), F.lit(-LARGEST))

    doubles = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    kept = doubles.where("size(v) > 0").where(F.forall("v", usable))
    return kept.select("vec_id", F.transform("v", whole).alias("y"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, d)


def _products(y: np.ndarray) -> np.ndarray:
    """Exact y' y; products that doubles hold exactly go through the fast multiplication."""
    largest = int(np.abs(y).max(initial=0))
    if largest * largest * len(y) < 2**53:
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    whole = y.astype(object)
    return whole.T @ whole


def scatter(distinct: DataFrame, d: int) -> tuple[int, list[int], list[list[int]]]:
    """(n, sums, n*P - S*S') of distinct vectors; one row for each place and task crosses the shuffle, in two limbs."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held = np.zeros((d + 1, d + 1), object), []

        def add():
            if held:
                y = np.concatenate(held)
                total[:d, :d] += _products(y)
                total[d, :d] += y.astype(object).sum(axis=0)
                total[d, d] += len(y)
                held.clear()

        for b in batches:
            held.append(_matrix(b["y"], d))
            if sum(map(len, held)) >= BLOCK:
                add()
        add()
        place = [(i, j) for i in range(d + 1) for j in range(i + 1)]
        values = [int(total[i, j]) for i, j in place]
        limbs = [pa.array([Decimal(part(v)) for v in values], pa.decimal128(38, 0)) for part in (lambda v: v >> 64, lambda v: v & (2**64 - 1))]
        yield pa.RecordBatch.from_arrays([pa.array([i * (d + 1) + j for i, j in place], pa.int64()), *limbs], ["place", "hi", "lo"])

    parts = distinct.mapInArrow(rows, "place long, hi decimal(38,0), lo decimal(38,0)")
    # as many rows as the matrix has places, whatever the number of vectors
    got = {r.place: (int(r.hi) << 64) + int(r.lo) for r in parts.groupBy("place").agg(F.sum("hi").alias("hi"), F.sum("lo").alias("lo")).collect()}
    at = lambda i, j: got[max(i, j) * (d + 1) + min(i, j)]
    n, sums = at(d, d), [at(d, j) for j in range(d)]
    return n, sums, [[n * at(i, j) - sums[i] * sums[j] for j in range(d)] for i in range(d)]


def _prime(p: int) -> bool:
    """Miller and Rabin, exact below 2**32 with these bases."""
    if p < 8 or p % 2 == 0:
        return p in (2, 3, 5, 7)
    odd, twos = p - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    return all(pow(b, odd, p) == 1 or any(pow(b, odd << k, p) == p - 1 for k in range(twos)) for b in (2, 3, 5, 7))


def primes(product: int) -> list[int]:
    """The largest primes below 2**31 whose product is above the given one."""
    found, at, so_far = [], 2**31 - 1, 1
    while so_far <= product:
        if _prime(at):
            found.append(at)
            so_far *= at
        at -= 2
    return found


def residues(matrix: list[list[int]], p: int) -> list[int]:
    """det(xI - matrix) modulo p, from the constant upwards, by reduction to Hessenberg form."""
    d = len(matrix)
    h = np.array([[v % p for v in row] for row in matrix], np.int64)
    for m in range(1, d - 1):
        below = np.flatnonzero(h[m:, m - 1])
        if not len(below):
            continue
        i = m + below[0]
        h[[i, m]] = h[[m, i]]
        h[:, [i, m]] = h[:, [m, i]]
        if m + 1 < d:
            u = h[m + 1 :, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
            h[m + 1 :, m - 1 :] = (h[m + 1 :, m - 1 :] - u[:, None] * h[m, m - 1 :]) % p
            h[:, m] = (h[:, m] + (h[:, m + 1 :] * u % p).sum(axis=1)) % p
    poly = np.zeros((d + 1, d + 1), np.int64)
    poly[0, 0] = 1
    below = np.ones(d, np.int64)  # below[m]: the product of the subdiagonal entries of rows m+1 to k-1
    for k in range(1, d + 1):
        if k > 1:
            below[: k - 1] = below[: k - 1] * h[k - 1, k - 2] % p
        poly[k, 1:] = poly[k - 1, :-1]
        factors = h[:k, k - 1] * below[:k] % p
        poly[k] = (poly[k] - (factors[:, None] * poly[:k] % p).sum(axis=0)) % p
    return poly[d].tolist()


def characteristic(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Exact coefficients of det(xI - matrix), from the constant upwards, of a matrix without negative eigenvalues."""
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    moduli = primes((1 + trace // d + 1) ** d)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b["id"].to_pylist()
            yield pa.RecordBatch.from_arrays([b["id"], pa.array([residues(matrix, moduli[k]) for k in ids], pa.list_(pa.int64()))], ["id", "found"])

    tasks = min(len(moduli), max(1, spark.sparkContext.defaultParallelism))
    got = spark.range(0, len(moduli), 1, tasks).mapInArrow(rows, "id long, found array<long>").collect()
    combined, product = [0] * (d + 1), 1
    for r in sorted(got):
        p = moduli[r.id]
        inverse = pow(product, -1, p)
        combined = [c + product * ((f - c) * inverse % p) for c, f in zip(combined, r.found, strict=True)]
        product *= p
    # the signs alternate, as no eigenvalue is negative
    return [c if (d - k) % 2 == 0 or c == 0 else c - product for k, c in enumerate(combined)]


def above(poly: list[int], a: int, s: int) -> int:
    """How many roots of a polynomial with real roots only are larger than a / 2**s: sign changes after the shift."""
    d = len(poly) - 1
    q = [c << (s * (d - k)) for k, c in enumerate(poly)]
    for low in range(d):
        for k in range(d - 1, low - 1, -1):
            q[k] += a * q[k + 1]
    signs = [c > 0 for c in q if c]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def _sign(poly: list[int], a: int, s: int) -> int:
    value = 0
    for k in range(len(poly) - 1, -1, -1):
        value = value * a + (poly[k] << (s * (len(poly) - 1 - k)))
    return (value > 0) - (value < 0)


def root(poly: list[int], rank: int) -> tuple[int, int]:
    """(a, s): the rank-th largest root, which must be positive, is in (a, a + 1] / 2**s with ROOT_BITS bits in a."""
    lo, hi, s = 0, 1, 0
    while above(poly, hi, 0) >= rank:
        lo, hi = hi, 2 * hi
    alone, parity = False, 0
    over_lo, over_hi = above(poly, lo, s), above(poly, hi, s)
    while lo.bit_length() < ROOT_BITS:
        if hi - lo == 1:
            lo, hi, s = 2 * lo, 2 * hi, s + 1
        mid = (lo + hi) // 2
        if not alone and over_lo - over_hi == 1 and _sign(poly, lo, s) and _sign(poly, hi, s):
            alone, parity = True, _sign(poly, hi, s)
        if alone:  # one simple root inside: the sign at the middle tells its side
            sign = _sign(poly, mid, s)
            lo, hi = (lo, mid) if sign in (0, parity) else (mid, hi)
            continue
        over = above(poly, mid, s)
        if over >= rank:
            lo, over_lo = mid, over
        else:
            hi, over_hi = mid, over
    return lo, s


def null_space(matrix: list[list[int]], eigenvalue: Fraction, size: int) -> np.ndarray:
    """So many orthonormal vectors that the matrix stretches by `eigenvalue`, each with its largest entry positive."""
    with decimal.localcontext(decimal.Context(prec=DIGITS, Emax=decimal.MAX_EMAX, Emin=decimal.MIN_EMIN)):
        d = len(matrix)
        value = Decimal(eigenvalue.numerator) / Decimal(eigenvalue.denominator)
        a = np.array([[Decimal(v) for v in row] for row in matrix], object)
        largest = max(abs(v) for v in a.flat)
        a[np.diag_indices(d)] -= value
        least = largest * Decimal(10) ** (-DIGITS * 2 // 3)
        order = list(range(d))
        for k in range(d):
            best = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
            if best != k:
                a[[k, best]] = a[[best, k]]
                order[k], order[best] = order[best], order[k]
            if abs(a[k, k]) < least:
                a[k, k] = least
            if k + 1 < d:
                a[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
                a[k + 1 :, k + 1 :] -= a[k + 1 :, k, None] * a[k, k + 1 :]
        start = np.random.default_rng(11).integers(1, 1000, (size, d))
        block = [np.array([Decimal(int(v)) for v in row], object) for row in start]
        for _ in range(3):
            solved = []
            for v in block:
                y = v[order]
                for k in range(d):
                    y[k + 1 :] -= a[k + 1 :, k] * y[k]
                for k in range(d - 1, -1, -1):
                    y[k] = y[k] / a[k, k]
                    y[:k] -= a[:k, k] * y[k]
                for _ in range(2):
                    for w in solved:
                        y = y - w * (w @ y)
                    y = y / (y @ y).sqrt()
                solved.append(y)
            block = solved
        found = np.array([[float(v) for v in w] for w in block])
    return found * np.sign(found[np.arange(size), np.abs(found).argmax(axis=1)])[:, None]


def principal(spark: SparkSession, matrix: list[list[int]], count: int) -> tuple[list[Fraction], np.ndarray]:
    """The largest positive eigenvalues of an integer matrix without negative ones, and orthonormal eigenvectors as rows."""
    d = len(matrix)
    if not any(map(any, matrix)):
        return [], np.zeros((0, d))
    poly = characteristic(spark, matrix)
    rank = d - next(k for k, c in enumerate(poly) if c)
    count = min(count, rank)

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [root(poly, k + 1) for k in b["id"].to_pylist()]
            columns = [b["id"], pa.array([str(a) for a, _ in found]), pa.array([s for _, s in found], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "a", "s"])

    got = sorted(spark.range(0, count, 1, count).mapInArrow(roots, "id long, a string, s long").collect())
    values = [Fraction(2 * int(r.a) + 1, 2 ** (r.s + 1)) for r in got]
    spaces: list[tuple[Fraction, int]] = []
    for v in values:
        if spaces and spaces[-1][0] - v <= v / 2 ** (ROOT_BITS - 4):
            spaces[-1] = (spaces[-1][0], spaces[-1][1] + 1)
        else:
            spaces.append((v, 1))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [null_space(matrix, *spaces[k]).ravel() for k in b["id"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["id"], pa.array(found, pa.list_(pa.float64()))], ["id", "found"])

    got = sorted(spark.range(0, len(spaces), 1, len(spaces)).mapInArrow(vectors, "id long, found array<double>").collect())
    return values, np.concatenate([np.reshape(r.found, (-1, d)) for r in got])


def _projected(y: np.ndarray, model: Model) -> np.ndarray:
    """Centred vectors on the components, over the roots of the eigenvalues; the centre is split, so nothing is rounded before it is subtracted."""
    whole = np.array([s // model.n for s in model.sums], np.int64)
    rest = np.array([float(Fraction(s % model.n, model.n)) for s in model.sums])
    if (np.abs(y).max(initial=0) >= 2**61) or (np.abs(whole).max(initial=0) >= 2**61):
        centred = (y.astype(object) - whole.astype(object)).astype(np.float64) - rest
    else:
        centred = (y - whole).astype(np.float64) - rest
    return centred @ model.components.T / np.sqrt(model.eigenvalues)


def _identity_error(distinct: DataFrame, model: Model) -> float:
    """The largest absolute entry of the whitened fit list's covariance minus the identity, from a pass over the list."""
    k, d = model.components.shape

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for b in batches:
            w = _projected(_matrix(b["y"], d), model)
            total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k)), pa.array(total.ravel())], ["place", "part"])

    parts = distinct.mapInArrow(rows, "place long, part double").groupBy("place").agg(F.sum("part").alias("part"))
    covariance = np.zeros(k * k)
    for r in parts.collect():
        covariance[r.place] = r.part
    return float(np.abs(covariance.reshape(k, k) / model.n - np.eye(k)).max())


def learn(vectors: DataFrame, components: int = 16, id_col: str = "vec_id", vector_col: str = "embedding") -> Model | None:
    """The whitening of these vectors, or None if they do not differ in anything."""
    spark = prepare(vectors.sparkSession)
    distinct = stored(entries(vectors, id_col, vector_col).groupBy("y").agg(F.count("*").alias("copies")).select("y"))
    common = distinct.groupBy(F.size("y").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if common is None:
        return None
    distinct = distinct.where(F.size("y") == common.d)
    n, sums, matrix = scatter(distinct, common.d)
    values, found = principal(spark, matrix, components)
    if not values:
        return None
    trace = sum(matrix[i][i] for i in range(common.d))
    eigenvalues = np.array([float(v / (n * n)) for v in values])
    model = Model(n, sums, found, eigenvalues, np.array([float(v / trace) for v in values]), 0.0)
    return model._replace(identity_error=_identity_error(distinct, model))


def _deviations(y: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The exact sum over dimensions of (n*y - sum) squared; None where a long is too short for it."""
    largest = n * int(np.abs(y).max(initial=0)) + max(map(abs, sums))
    whole = np.array(sums, np.int64 if largest < 2**62 else object)
    apart = y.astype(whole.dtype) * n - whole
    if largest * largest * len(sums) >= 2**63:
        apart = apart.astype(object)
    return [int(v) if v < 2**63 else None for v in (apart * apart).sum(axis=1)]


def whitened(vectors: DataFrame, model: Model | None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each usable vector and component."""
    usable = entries(vectors, id_col, vector_col)
    kind = usable.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    k, d = model.components.shape

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            y = _matrix(b["y"], d)
            each = np.repeat(np.arange(len(y)), k)
            columns = [
                b["vec_id"].take(pa.array(each)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(y))),
                pa.array(np.full(len(each), model.n)),
                pa.array(_deviations(y, model.n, model.sums), pa.int64()).take(pa.array(each)),
                pa.array(_projected(y, model).ravel()),
                pa.array(np.tile(model.explained, len(y))),
                pa.array(np.full(len(each), model.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return usable.where(F.size("y") == d).mapInArrow(rows, schema)
