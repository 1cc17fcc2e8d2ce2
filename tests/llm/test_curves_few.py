from __future__ import annotations

import numpy as np
import pytest

from martlens.llm import curves


@pytest.mark.parametrize("distinct, copies", [(10, 1), (21, 1), (30, 1), (10, 3), (40, 2)])
def test_few_vectors_fill_the_ranks(ready, distinct, copies):
    points = np.random.default_rng(distinct).standard_normal((distinct, 8))
    rows = [(i, points[i % distinct].tolist()) for i in range(distinct * copies)]
    vectors = ready.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in curves.neighbours(vectors, "vec_id % 5 = 0", 20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert sorted(got) == list(range(0, len(rows), 5))
    for q, found in got.items():
        want = sorted((-float(points[q % distinct] @ points[i % distinct]), i) for i, _ in rows if i != q)[:20]
        assert len(found) == min(20, len(rows) - 1)
        if distinct <= 21:
            assert np.allclose([s for _, s in found], [-s for s, _ in want])


def test_windows_hold_enough():
    held = np.random.default_rng(1).integers(0, 3, (4, 64))
    first, past = curves._windows(held, 5, 21)
    for c, b in np.ndindex(held.shape):
        assert first[c, b] <= b < past[c, b] and past[c, b] - first[c, b] >= 5 and held[c, first[c, b] : past[c, b]].sum() >= 21
    few = np.zeros((1, 64), np.int64)
    few[0, [3, 40]] = 1
    first, past = curves._windows(few, 5, 21)
    assert (first <= 3).all() and (past > 40).all()


def test_scores_do_not_depend_on_the_blocks(ready, monkeypatch):
    monkeypatch.setattr(curves, "CHUNK", 7)
    monkeypatch.setattr(curves, "SLICE", 3)
    rng = np.random.default_rng(8)
    base = rng.standard_normal(24)
    # vectors of one set of components: their products with the first differ in the last bits only, or not at all
    points = [np.ones(24), *(rng.permutation(base) for _ in range(60))]
    vectors = ready.createDataFrame([(i, v.tolist()) for i, v in enumerate(points)], "vec_id long, embedding array<double>")
    got = curves.neighbours(vectors, "vec_id = 0", 20, window=64).orderBy("rank").collect()
    want = sorted((-float((v * points[0]).sum()), i) for i, v in enumerate(points) if i)[:20]
    assert [(-r.score, r.vec_id) for r in got] == want
