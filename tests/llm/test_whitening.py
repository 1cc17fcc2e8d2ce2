from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from martlens.llm import whitening
from martlens.llm.common import table
from martlens.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def plain(vectors):
    """Everything the query returns, by numpy's own decomposition."""
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors], dtype=object)
    fit = np.unique(x.astype(np.int64), axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, found = np.linalg.eigh(centred.T @ centred / n)
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    return n, deviation, values[::-1], found[:, ::-1].T, x.astype(np.float64) - sums / n


def check(rows, vectors):
    n, deviation, values, found, centred = plain([v for _, v in vectors])
    count = min(16, int((values > 1e-9 * values[0]).sum()))
    assert len(rows) == count * len(vectors)
    got = {}
    for r in rows:
        got.setdefault(r.vec_id, {})[r.component] = r
    by_id = [got[i] for i, _ in vectors]
    assert all(sorted(g) == list(range(1, count + 1)) for g in by_id)
    assert [g[1].deviation for g in by_id] == deviation and {r.n for r in rows} == {n}
    for k in range(count):
        column = np.array([g[k + 1].whitened for g in by_id])
        want = centred @ found[k] / math.sqrt(values[k])
        apart = min(abs(values[k] - values[j]) for j in range(len(values)) if j != k)
        if apart > 1e-6 * values[0]:
            assert min(np.abs(column - want).max(), np.abs(column + want).max()) < 1e-5
        assert abs(by_id[0][k + 1].explained - values[k] / values.sum()) < 1e-8
    assert {r.identity_error for r in rows} == {rows[0].identity_error} and rows[0].identity_error < 1e-9


def test_sample_vectors_as_a_plain_decomposition(ready):
    vectors = [(r.vec_id, r.embedding) for r in table(ready, FOLDER, "embeddings").collect()]
    check(QUERIES["op11_embedding_whitening"](ready, FOLDER).collect(), vectors)


def frame(ready, rows):
    return ready.createDataFrame(rows, "vec_id long, embedding array<double>, y int, component string")


def apply(ready, rows):
    df = frame(ready, [(i, v, 0, "c") for i, v in rows])
    return whitening.whitened(df, whitening.learn(df)).collect()


def test_small_and_repeated_vectors(ready):
    rnd = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(rnd.standard_normal((40, 5)))]
    rows += [(100 + i, rows[0][1]) for i in range(60)]  # a hot vector counts once in the fit
    check(apply(ready, rows), rows)


def test_odd_vectors_take_no_part(ready):
    good = [(i, [i * 0.5, i * i * 0.25, -0.75]) for i in range(6)]
    odd = [(90, None), (91, []), (92, [1.0, None, 2.0]), (93, [1.0, math.nan, 2.0]), (94, [math.inf, 1.0, 2.0]), (95, [1.0, 2.0])]
    rows = apply(ready, good + odd)
    assert {r.vec_id for r in rows} == set(range(6)) and {r.component for r in rows} == {1, 2}
    check(rows, good)
    again = apply(ready, [*good, (5, good[5][1]), (None, good[4][1])])
    assert sum(r.vec_id == 5 for r in again) == 4 and sum(r.vec_id is None for r in again) == 2
    assert apply(ready, []) == apply(ready, [(1, [1.0, 2.0])]) == apply(ready, [(1, [1.0]), (2, [1.0])]) == []


def test_huge_entries_stay_exact(ready):
    rows = [(0, [2.0**50, 1.0]), (1, [-(2.0**50), 3.0]), (2, [0.0, -5.0]), (3, [1e300, 0.0])]
    got = {r.vec_id: r for r in apply(ready, rows) if r.component == 1}
    assert len(got) == 4 and got[0].deviation is None and max(r.identity_error for r in got.values()) < 1e-6


def matrices():
    rnd = np.random.default_rng(8)
    a = rnd.integers(-40, 40, (9, 14))
    yield (a @ a.T).tolist()
    yield (a[:, :4] @ a[:, :4].T).tolist()  # rank 4
    yield np.diag([7, 7, 7, 3, 3, 0]).tolist()
    q = np.array([[1, 1, 1, 1], [1, -1, 1, -1], [1, 1, -1, -1], [1, -1, -1, 1]])
    yield (q @ np.diag([5, 9, 9, 2]) @ q.T).tolist()  # eigenvalues 36, 36, 20, 8
    yield [[4]]


def determinant(rows):
    """By exact fractions."""
    a, value = [[Fraction(v) for v in row] for row in rows], Fraction(1)
    for k in range(len(a)):
        pivot = next((i for i in range(k, len(a)) if a[i][k]), None)
        if pivot is None:
            return 0
        if pivot != k:
            a[k], a[pivot], value = a[pivot], a[k], -value
        value *= a[k][k]
        for i in range(k + 1, len(a)):
            factor = a[i][k] / a[k][k]
            a[i] = [x - factor * y for x, y in zip(a[i], a[k])]
    return value


@pytest.mark.parametrize("matrix", list(matrices()))
def test_polynomial_roots_and_null_spaces(ready, matrix):
    d = len(matrix)
    poly = whitening.characteristic(ready, matrix)
    for x in range(-3, d + 1):
        assert sum(c * x**k for k, c in enumerate(poly)) == determinant([[x * (i == j) - matrix[i][j] for j in range(d)] for i in range(d)])
    for p in (2**31 - 1, 101, 7):
        assert [c % p for c in poly] == whitening.residues(matrix, p)
    values, found = whitening.principal(ready, matrix, d)
    want = np.linalg.eigvalsh(np.array(matrix, float))[::-1]
    rank = np.linalg.matrix_rank(np.array(matrix))
    assert len(values) == rank and np.allclose([float(v) for v in values], want[:rank], rtol=1e-9)
    assert np.abs(found @ found.T - np.eye(rank)).max() < 1e-12
    assert np.abs(found @ np.array(matrix, float) - np.diag([float(v) for v in values]) @ found).max() < 1e-9 * want[0]


def test_root_counts_are_exact():
    poly = [1]
    for r in (3, 3, 5, 11):  # (x-3)^2 (x-5) (x-11)
        poly = [b - r * a for a, b in zip([*poly, 0], [0, *poly])]
    assert [whitening.above(poly, a, 1) for a in (0, 5, 6, 7, 10, 21, 22)] == [4, 4, 2, 2, 1, 1, 0]
    for rank, value in enumerate((11, 5, 3, 3), 1):
        a, s = whitening.root(poly, rank)
        assert Fraction(a, 2**s) < value <= Fraction(a + 1, 2**s) and a.bit_length() >= whitening.ROOT_BITS
