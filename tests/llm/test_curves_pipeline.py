from __future__ import annotations

import hashlib

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from martlens.llm import curves
from martlens.llm.common import stored, table
from martlens.llm.queries import QUERIES
from tests.llm.test_repeats import brute
from tests.llm.test_near_copies import brute as all_pairs

FOLDER = "/root/testdata/sf0.001"


def exact(rows, query, k):
    at = dict(rows)
    scores = [(-float(np.dot(at[query], v)), i) for i, v in rows if i != query]
    return [(i, -s) for s, i in sorted(scores)[:k]]


@pytest.mark.parametrize("bits, axes", [(1, 2), (4, 2), (3, 3), (2, 6)])
def test_hilbert_curves_step_to_a_neighbouring_cell(bits, axes):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), axis=-1).reshape(-1, axes)
    keys = curves.hilbert_keys(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_recall_and_scores(ready):
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in ready.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    got = {}
    for r in QUERIES["op6_curve_neighbours"](ready, "/root/testdata/sf0.01").orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r)
    assert sorted(got) == sorted(i for i, _ in rows if i % 20 == 0)
    hits = 0
    for q, found in got.items():
        want = dict(exact(rows, q, 20))
        hits += len(want.keys() & {r.vec_id for r in found})
        assert [r["rank"] for r in found] == list(range(1, 21)) and q not in {r.vec_id for r in found}
        assert all(a.score >= b.score for a, b in zip(found, found[1:]))
        at = dict(rows)
        assert all(abs(r.score - np.dot(at[q], at[r.vec_id])) < 1e-12 for r in found)
    assert hits / (20 * len(got)) >= 0.9


def test_hard_vectors(ready, monkeypatch):
    monkeypatch.setattr(curves, "CHUNK", 3)
    monkeypatch.setattr(curves, "SLICE", 2)
    rows = [(i, [1.0, 0.0, 0.5]) for i in range(0, 30)] + [(40, [0.0, 2.0, 0.0]), (41, [1.0, 1.0, 1.0]), (41, [1.0, 1.0, 1.0])]
    rows += [(50, None), (51, [0.0, 0.0, 0.0]), (52, [1.0, None, 0.0]), (53, [float("nan"), 1.0, 0.0]), (54, [float("inf"), 1.0, 0.0])]
    rows += [(55, [1.0]), (60, []), (None, [1.0, 2.0, 3.0])]
    vectors = ready.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rep", F.lit(0)).withColumn("vec", F.lit("x"))
    got = {}
    for r in curves.neighbours(vectors, "vec_id % 20 = 0", 5).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    # copies of one vector: ties go to the smaller ids, never to the query itself; 60 holds no vector
    assert got == {0: [41, 1, 2, 3, 4], 20: [41, 0, 1, 2, 3], 40: [41, 0, 1, 2, 3]}
    few = curves.neighbours(vectors.where("vec_id in (20, 40, 41)"), "vec_id = 20", 5)
    assert [r.vec_id for r in few.orderBy("rank").collect()] == [41, 40]
    assert curves.neighbours(vectors.limit(0), "vec_id = 20", 5).count() == 0


def test_stages_against_brute_force(ready):
    docs = table(ready, FOLDER, "documents")
    rows = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stored(stage(ready, before, FOLDER))
        rows[name] = docs
        if name != "best-fit packing":
            assert docs.columns == before.columns and 0.5 * before.count() < docs.count() <= before.count()
    texts = lambda df: {r.doc_id: r.text for r in df.collect()}
    judged = texts(rows["toxicity"])
    best = all_pairs(list(judged.items()))
    assert sorted(texts(rows["near duplicates"])) == best
    want = brute([(i, judged[i]) for i in best], 100)
    cut = texts(rows["repeated passages"])
    assert cut == {i: b.decode("utf-8", "ignore") for i, b in want.items()}
    assert {r.doc_id for r in rows["best-fit packing"].collect()} == set(cut)


def test_clean_documents_stay(ready):
    docs = table(ready, "/root/testdata/sf0.01", "documents")
    labels = {r.doc_id: r for r in table(ready, "/root/testdata/sf0.01", "labels").collect()}
    good = corpus_pipeline.good_quality(ready, docs, "/root/testdata/sf0.01")
    kept = {r.doc_id for r in corpus_pipeline.not_toxic(ready, stored(good), "/root/testdata/sf0.01").select("doc_id").collect()}
    clean = [i for i, r in labels.items() if r.quality and not r.toxic]
    assert np.mean([i in kept for i in clean]) >= 0.97


def test_op1_digests(ready):
    rows = [(r.doc_id, r.text) for r in table(ready, FOLDER, "documents").collect()]
    want = brute(rows, 100)
    for r in QUERIES["op1_repeated_windows"](ready, FOLDER).collect():
        assert r.kept_sha256 == hashlib.sha256(want[r.doc_id]).hexdigest() and r.n_bytes - r.n_removed == len(want[r.doc_id])


def test_pipeline_on_hard_rows(ready, hard, nothing, tmp_path):
    ready.createDataFrame([(4, 1, 0), (6, 1, 0), (10, 0, 0), (11, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (hard, nothing):
        at = docs
        for _, stage in corpus_pipeline.STAGES:
            at = stored(stage(ready, at, str(tmp_path)))
        assert set(at.columns) == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
    assert at.count() == 0
