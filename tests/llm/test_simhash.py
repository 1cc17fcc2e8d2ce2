from __future__ import annotations

import random

import xxhash
from pyspark.sql import functions as F

from martlens.llm import simhash


def plain_fingerprint(text):
    import re

    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, distance):
    """Smallest member of each value's group, by comparing all pairs."""
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a in values:
        for b in values:
            if a < b and (a ^ b).bit_count() <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def test_fingerprints(hard):
    for text in ["", "  ", "a", "A b", "one two three four", "É é Z z " * 30, "x\x0by\x0cz\x85w"]:
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_spark_hashes_the_same_way(ready):
    rows = ready.createDataFrame([("one two three",)], "s string").select(F.xxhash64("s").alias("h")).first()
    assert rows.h % 2**64 == xxhash.xxh64_intdigest(b"one two three", 42)


def test_links_and_components_as_all_pairs(ready):
    rnd = random.Random(1)
    values = set()
    for _ in range(25):
        v = rnd.getrandbits(64)
        for _ in range(rnd.randint(1, 9)):  # a chain of neighbours
            values.add(v)
            for _ in range(rnd.randint(1, 3)):
                v ^= 1 << rnd.randrange(64)
    signed = [(v - 2**64 if v >> 63 else v,) for v in values]
    classes = ready.createDataFrame(signed, "fp long")
    ids = [s[0] for s in signed]
    for distance, segments in ((2, 2), (3, 2), (1, 2), (3, 4)):
        got = {(r.u, r.v) for r in simhash.links(classes, distance, segments).collect()}
        want = {(a, b) for a in ids for b in ids if a < b and ((a ^ b) % 2**64).bit_count() <= distance}
        assert got == want, (distance, segments)
    found = {r.node: r.root for r in simhash.components(simhash.links(classes)).collect()}
    unsigned = groups([i % 2**64 for i in ids], 2)
    for i in ids:
        mine = {j for j in ids if unsigned[j % 2**64] == unsigned[i % 2**64]}
        assert found.get(i, i) == min(mine)


def test_hard_rows(hard, nothing):
    got = simhash.near_duplicates(hard).collect()
    assert len(got) == hard.count()
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].fp == by_id[2].fp == by_id[3].fp == 0 and by_id[3].component_id == 1
    assert by_id[7].component_id == 6
    assert by_id[None].component_id is None
    kept = simhash.without_near_duplicates(hard)
    assert kept.columns == hard.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and 7 not in ids and 2 not in ids and None in ids
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.without_near_duplicates(nothing).count() == 0


def test_a_large_group_of_copies_is_one(ready):
    docs = ready.range(3000).select(F.col("id").alias("doc_id"), F.lit("many copies of one text").alias("text"))
    got = simhash.near_duplicates(docs).select("component_id").distinct().collect()
    assert [r.component_id for r in got] == [0]
    assert simhash.without_near_duplicates(docs).count() == 1
