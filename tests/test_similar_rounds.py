"""Rounds of the search for near duplicates move only the sets that are still asked about."""

from __future__ import annotations

from martlens.operators import similarity


def test_sets_of_settled_rows_stay_behind(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(similarity, "work_dir", lambda *_: str(tmp_path / "similar"))
    lone = [(k, " ".join(f"w{k}_{i}" for i in range(30))) for k in range(20)]
    words = [f"c{i}" for i in range(60)]
    alike = [(100 + k, " ".join([*words, f"end{k}"])) for k in range(4)]
    rows = spark.createDataFrame(lone + alike, "id long, text string")
    got = {r.id: r.group_id for r in similarity.near_duplicate_groups(rows, "id", similarity.word_shingles("text")).collect()}
    assert got == {**{k: k for k in range(20)}, **dict.fromkeys(range(100, 104), 100)}
    tables = [spark.read.parquet(str(path)) for path in (tmp_path / "similar").iterdir()]
    assert sorted(t.count() for t in tables if t.columns == ["node", "tokens"]) == [4]
