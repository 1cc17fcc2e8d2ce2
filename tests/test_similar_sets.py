"""What the search for near duplicates sends between tasks, how often it asks, and its words."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from martlens.operators import similarity
from tests.test_similarity import brute, grouped, shingled


def written(spark, folder, *columns):
    tables = [spark.read.parquet(str(path)) for path in folder.iterdir()]
    return [t for t in tables if t.columns == list(columns)]


def test_only_the_first_fifth_of_a_set_is_filed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(similarity, "work_dir", lambda *_: str(tmp_path / "similar"))
    rows = [(k, " ".join(f"w{k}_{i}" for i in range(104))) for k in range(30)]
    assert grouped(spark, rows) == {k: k for k in range(30)}
    # a table of all tokens or all sets would have 3,000 of them, and these sets of 100 have 21 each in the one that is kept
    (placed,) = written(spark, tmp_path / "similar", "node", "n", "first", "bits")
    assert sorted(len(r.first) for r in placed.collect()) == [21] * 30
    arrays = [t for t in (spark.read.parquet(str(p)) for p in (tmp_path / "similar").iterdir()) if any(kind.startswith("array") for _, kind in t.dtypes)]
    assert sum(t.count() for t in arrays) == 30


def test_large_buckets_of_unlike_sets_take_few_rounds(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(similarity, "work_dir", lambda *_: str(tmp_path / "similar"))
    monkeypatch.setattr(similarity, "COMMON", 1000)
    monkeypatch.setattr(similarity, "HUBS", 4)
    rnd = random.Random(3)
    shared = [f"s{i}" for i in range(40)]
    rows = [(k, " ".join(shared + [f"x{rnd.randrange(10**9)}" for _ in range(16)])) for k in range(80)]
    rows += [(100 + k, " ".join([*shared, *(f"y{i}" for i in range(60)), f"end{k}"])) for k in range(30)]
    assert grouped(spark, rows) == brute({i: shingled(t) for i, t in rows})
    # 1, 8 and 64 sets stand for a bucket of 110 sets; with 4 at a time there would be 28 rounds
    assert 1 <= len(written(spark, tmp_path / "similar", "bucket", "node", "n", "place", "root")) <= 12


@pytest.mark.parametrize("span", [1, 40, 1 << 21])
def test_words_of_any_length_and_space(spark, monkeypatch, span):
    monkeypatch.setattr(similarity, "SPAN", span)
    long = "A" * 70
    texts = [None, "", " \t\n", "one", "ONE ", "\x0bone\x0c", "one two three four five", " one  Two\rthree four five", "one two three four five six"]
    texts += [f"{long} b c d e", f"{long.lower()} b c d e", f"{long}a b c d e", "é ü b c d", "É ü b c d", "12345678 a b c d", "12345678a b c d e", "a b a b a b a b a b", "a\xa0b c d e f"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").select("id", similarity.word_shingles("text").alias("t"))
    got = {r.id: r.t for r in df.collect()}

    def words(t):
        low = "".join(ch.lower() if ch.isascii() else ch for ch in t or "")
        return [w for w in low.translate(dict.fromkeys(map(ord, "\t\n\x0b\x0c\r"), " ")).split(" ") if w]

    def runs(t):
        found = words(t)
        return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set()

    told = {}
    for i, t in enumerate(texts):
        assert len(got[i]) == len(set(got[i])) == len(runs(t)), t
        for j, other in enumerate(texts):
            assert len(set(got[i]) & set(got[j])) == len(runs(t) & runs(other)), (t, other)
        told.setdefault(frozenset(runs(t)), set()).add(tuple(got[i]))
    assert all(len(x) == 1 for x in told.values())


def test_bit_strings_never_differ_more_than_their_sets():
    rng = np.random.default_rng(5)
    for n in (4, 100, 2048, 2049, 5000):
        pool = np.unique(rng.integers(-(2**63), 2**63 - 1, 2 * n, dtype=np.int64))
        for cut in (n, n + n // 4):
            a, b = pool[:n], pool[n // 10 : cut]
            assert similarity._differing(similarity._odd(a), similarity._odd(b)) <= len(np.setxor1d(a, b))
        assert similarity._differing(similarity._odd(a), similarity._odd(a)) == 0


def test_common_tokens_come_last(spark):
    rare, common = list(range(1, 200, 2)), list(range(0, 40, 2))
    marks = np.zeros(similarity.SLOTS, np.uint8)
    marks[common] = 4

    class Order:
        value = marks

    def first(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["first"]], ["first"])

    own = spark.createDataFrame([(rare + common,)], "tokens array<bigint>")
    (row,) = similarity._placed(own, Order()).mapInArrow(first, "first array<long>").collect()
    assert row.first == rare[:25]
