from __future__ import annotations

import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from martlens.llm import near_copies, simhash
from martlens.llm.common import stored, table


def brute(rows):
    """The smallest id of every group, by the true Jaccard similarity of all pairs."""
    sets = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted({find(i) for i in sets})


def stage(ready, docs):
    return sorted(r.doc_id for r in corpus_pipeline.one_of_each_group(ready, docs, "").collect())


def test_sample_documents_as_all_pairs(ready):
    docs = table(ready, "/root/testdata/sf0.01", "documents")
    assert stage(ready, docs) == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_chains_and_large_groups_as_all_pairs(ready):
    rnd = random.Random(7)
    word = lambda: rnd.choice("abcdefghij") + str(rnd.randrange(300))
    rows = []
    for size in (1, 1, 2, 3, 9, 120):
        words = [word() for _ in range(rnd.randint(60, 150))]
        for _ in range(size):
            mine = list(words)
            for _ in range(rnd.randint(0, 3)):
                mine[rnd.randrange(len(mine))] = word()
            rows.append((len(rows), " ".join(mine)))
            if size == 9:  # a chain: the ends are unlike
                words = mine
    rows += [(900, None), (901, " "), (902, "One two"), (903, "one  TWO"), (904, "one three")]
    docs = ready.createDataFrame(rows, "doc_id long, text string").withColumn("text_hash", F.lit(0))
    want = brute(rows)
    assert len(want) < len(rows) // 2 and stage(ready, docs) == want


def test_similarity_is_of_the_whole_sets():
    a, b = near_copies.shingles(" ".join(map(str, range(14)))), near_copies.shingles(" ".join(map(str, range(13))))
    assert len(a) == 10 and near_copies.similar(a, b) and not near_copies.similar(a, a[:7]) and near_copies.similar(a, a[:8])


def prepared(ready, texts):
    """members of one bucket, the bit strings and the sets of some texts, each a group of its own."""
    found = [near_copies.shingles(t) for t in texts]
    nodes = [(1, k, len(s), k) for k, s in enumerate(found)]
    members = ready.createDataFrame(nodes, "bucket long, node long, n long, root long")
    prints = ready.createDataFrame([(k, len(s), near_copies.parity(s)) for k, s in enumerate(found)], "node long, n long, parity binary")
    sets = ready.createDataFrame([(k, s.tobytes()) for k, s in enumerate(found)], "node long, found binary")
    return found, members, prints, sets


def mixed(rnd, count):
    word = lambda: rnd.choice("abcdef") + str(rnd.randrange(500))
    base, passage = [word() for _ in range(200)], " ".join(word() for _ in range(12))
    texts = []
    for k in range(count):
        mine = list(base) if k % 3 else [word() for _ in range(200)]
        for _ in range(rnd.randrange(6)):
            mine[rnd.randrange(200)] = word()
        texts.append(passage + " " + " ".join(mine))
    return texts


@pytest.mark.parametrize("block", [7, 512])
def test_open_buckets_in_blocks_as_all_pairs(ready, monkeypatch, block):
    monkeypatch.setattr(near_copies, "BLOCK", block)
    found, members, prints, sets = prepared(ready, mixed(random.Random(2), 60))
    kept = stored(near_copies._likely(members, sets))
    assert {r.node for r in kept.collect()} == {k for k in range(60) if k % 3}  # texts that only share a passage leave
    pairs = near_copies._in_blocks(kept, prints)
    met = {(r.u, r.v) for r in pairs.collect()}
    linked = {(a, b) for a in range(60) for b in range(a + 1, 60) if near_copies.similar(found[a], found[b])}
    assert linked <= met and len(met) == pairs.count()
    assert {(r.u, r.v) for r in near_copies._verified(pairs, prints, sets).collect()} == linked
    thinned = near_copies._thinned(ready.createDataFrame([(a, b) for a in range(60) for b in range(a)], "u long, v long"), prints)
    assert {(r.v, r.u) for r in thinned.collect()} >= linked


def test_slices_of_partners_meet_one_set(ready, monkeypatch):
    monkeypatch.setattr(near_copies, "SLICE", 500)
    found, _, prints, sets = prepared(ready, mixed(random.Random(4), 40))
    pairs = ready.createDataFrame([(1, b) for b in range(40) if b != 1], "u long, v long")
    got = {r.v for r in near_copies._verified(pairs, prints, sets).collect()}
    assert got == {b for b in range(40) if b != 1 and near_copies.similar(found[1], found[b])}


def test_odd_rows(ready, hard, nothing):
    kept = stage(ready, hard.where("doc_id is not null"))
    # null, empty and blank texts are copies of each other, as are equal ones
    assert kept == [1, 4, 5, 6, 8, 9, 10, 11, 12, 13, 14]
    assert sum(r.doc_id is None for r in corpus_pipeline.one_of_each_group(ready, hard, "").collect()) == 1
    assert corpus_pipeline.one_of_each_group(ready, nothing, "").count() == 0


def test_fingerprints_find_near_copies_first(ready):
    rnd = random.Random(9)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(4000)]
    rows = [(0, " ".join(base)), (1, " ".join(base[1:])), (2, " ".join(base[2:])), (3, " ".join(reversed(base))), (4, None)]
    classes = near_copies._classes(ready.createDataFrame(rows, "doc_id long, text string"))
    named = {r.node: (r.best.doc_id, r.fp) for r in classes.collect()}
    met = {frozenset((named[r.u][0], named[r.v][0])) for r in near_copies._by_fingerprint(classes).collect()}
    assert named and all(fp == simhash.fingerprint((text or ""), 5) - ((fp < 0) << 64) for i, text in rows for d, fp in named.values() if d == i)
    near = {frozenset((a, b)) for a, x in named.values() for b, y in named.values() if a < b and ((x ^ y) & (2**64 - 1)).bit_count() <= 2}
    assert near and met == near
