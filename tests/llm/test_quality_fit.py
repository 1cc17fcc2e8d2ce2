"""The driver holds no sample of the quality classifier."""

from __future__ import annotations

from pyspark import TaskContext

from martlens.llm import quality

FOLDER = "/root/testdata/sf0.01"


def test_a_task_fits(ready, monkeypatch):
    plain = quality._decomposed

    def in_a_task(x, dimensions):
        assert TaskContext.get() is not None
        return plain(x, dimensions)

    monkeypatch.setattr(quality, "_decomposed", in_a_task)
    docs, labels = (ready.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.learn(docs, labels)
    assert model.space.shape == ((1 << quality.BUCKETS_LOG) + 4, quality.DIMENSIONS)
    assert model.vectors.shape == (len(model.votes), quality.DIMENSIONS) and set(model.votes) == {0, 1}
