from __future__ import annotations

import zlib
from collections import Counter

import pytest
from pyspark.errors import AnalysisException

from martlens.llm import sharding
from martlens.llm.common import table
from martlens.llm.queries import QUERIES


def shares(rows):
    loads = Counter()
    for shard, size in rows:
        loads[shard] += size
    return loads


def gapless(rows):
    places = {}
    for shard, place in rows:
        places.setdefault(shard, []).append(place)
    return all(sorted(p) == list(range(len(p))) for p in places.values())


@pytest.mark.parametrize("folder, apart", [("/root/testdata/sf0.01", 0.05), ("/root/testdata/sf0.1", 0.005)])
def test_sample_documents(ready, folder, apart):
    docs = {r.doc_id: (r.text or "").encode() for r in table(ready, folder, "documents").collect()}
    rows = QUERIES["op13_virtual_slots"](ready, folder).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        assert r.size == len(docs[r.doc_id]) + 8 and r.text_crc32 == zlib.crc32(docs[r.doc_id])
        assert (r.law, r.grown_shard, r.map_version) == ("bytes", None, 2)
    loads = shares((r.shard, r.size) for r in rows)
    mean = sum(loads.values()) / 24
    assert sorted(loads) == list(range(24)) and max(loads.values()) - min(loads.values()) < apart * mean
    assert gapless((r.shard, r.slot) for r in rows)


def placed(ready, docs, shards, folder):
    stored, version = sharding.sharded(docs, shards, str(folder))
    return stored.select("doc.*", "slot", "shard", "place").collect(), version


def test_a_third_of_the_rows_alike(ready, tmp_path):
    rows = [(None, "the same " * 30)] * 800 + [(i, f"text {i} " * (1 + i % 40)) for i in range(1600)]
    docs = ready.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got, _ = placed(ready, docs, 6, tmp_path)
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    loads = shares((r.shard, len(r.text) + 8) for r in got)
    assert max(loads.values()) - min(loads.values()) < 0.01 * sum(loads.values()) / 6 and gapless((r.shard, r.place) for r in got)


def test_odd_rows_keep_their_columns(ready, hard, nothing, tmp_path):
    clashing = hard.selectExpr("*", "doc_id as slot", "doc_id as shard", "'p' as part", "1 as place", "'f' as file", "2 as bytes", "'d' as shards")
    stored, _ = sharding.sharded(clashing, 3, str(tmp_path / "a"))
    assert Counter(map(tuple, stored.select("doc.*").collect())) == Counter(map(tuple, clashing.collect()))
    assert gapless((r.shard, r.place) for r in stored.select("shard", "place").collect())
    none, version = placed(ready, nothing, 3, tmp_path / "b")
    assert none == [] and version == 2


def weights():
    return [sharding.Cell(s, -1, (s * 7919) % 1000) for s in range(1, sharding.SLOTS)] + [sharding.Cell(0, p, 9_000) for p in range(sharding.PARTS)]


def test_maps_are_edited_and_versioned(ready, tmp_path):
    folder = str(tmp_path / "map")
    assert sharding.latest(ready, folder) == (0, None)
    first = sharding.dealt(24)
    second = sharding.rebalanced(first, weights(), 24)
    third = sharding.grown(second, weights(), 24)
    assert [sharding.stored_version(ready, m, folder) for m in (first, second, third)] == [1, 2, 3]
    assert sharding.latest(ready, folder) == (3, third) and sharding.latest(ready, folder, 1) == (1, first)
    moved = ready.read.parquet(f"{folder}/version=2").where("moved").count()
    assert moved == sum(first[s] != second[s] for s in first) and 0 < moved < sharding.SLOTS / 4
    with pytest.raises(AnalysisException):
        ready.createDataFrame([], sharding.MAP).write.mode("errorifexists").parquet(f"{folder}/version=3")


def test_one_more_shard_takes_rows_only_into_itself():
    second = sharding.rebalanced(sharding.dealt(24), weights(), 24)
    third = sharding.grown(second, weights(), 24)
    at = lambda shards: {c: sharding._of(shards, c) for c in weights()}
    before, after = at(second), at(third)
    assert all(after[c] in (before[c], 24) for c in before)
    loads = shares((s, c.bytes) for c, s in after.items())
    mean = sum(loads.values()) / 25
    assert abs(loads[24] - mean) < 0.02 * mean and max(loads.values()) < 1.02 * mean
    assert sharding.rebalanced(second, weights(), 24) == second
