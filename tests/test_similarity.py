from __future__ import annotations

import random

import pytest

from martlens.operators import graphs, similarity


def brute(sets):
    """The smallest key of every row's group, by the true similarity of all pairs."""
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
    return {i: find(i) for i in sets}


def shingled(text, n=5):
    words = (text or "").lower().split()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def grouped(spark, rows):
    df = spark.createDataFrame(rows, "id long, text string")
    return {r.id: r.group_id for r in similarity.near_duplicate_groups(df, "id", similarity.word_shingles("text")).collect()}


def texts():
    rnd = random.Random(11)
    word = lambda: rnd.choice("abcdefgh") + str(rnd.randrange(400))
    passage = " ".join(word() for _ in range(40))
    rows = []
    for size in (1, 2, 5, 90):
        words = [word() for _ in range(rnd.randint(100, 140))]
        for _ in range(size):
            mine = list(words)
            for _ in range(rnd.randint(0, 2)):
                mine[rnd.randrange(len(mine))] = word()
            rows.append((len(rows), " ".join(mine)))
            if size == 5:  # a chain: its ends are unlike
                words = mine
    # many texts share one passage and little else
    rows += [(1000 + i, passage + " " + " ".join(word() for _ in range(60))) for i in range(25)]
    rows += [(2000, None), (2001, " \n"), (2002, "Two words"), (2003, "two  WORDS"), (2004, "two other"), (2005, "Two words")]
    return rows


@pytest.mark.parametrize("common, hubs", [(2, 8), (16, 64)])
def test_groups_as_all_pairs(spark, monkeypatch, common, hubs):
    monkeypatch.setattr(similarity, "COMMON", common)
    monkeypatch.setattr(similarity, "HUBS", hubs)
    rows = texts()
    want = brute({i: shingled(t) for i, t in rows})
    # rows without words are alike among themselves
    want.update({2001: 2000})
    assert len(set(want.values())) < len(rows) - 70
    assert grouped(spark, rows) == want


def test_exactly_four_fifths_is_similar(spark):
    words = [f"w{i}" for i in range(13)]
    a, b = " ".join(words), " ".join(words[:11])  # nine runs and seven of them: 7/9
    c = " ".join([*words, "x"])  # nine of ten
    assert grouped(spark, [(1, a), (2, b)]) == {1: 1, 2: 2}
    assert grouped(spark, [(1, a), (3, c)]) == {1: 1, 3: 1}
    eight = " ".join(words[:12])
    assert grouped(spark, [(1, eight), (2, " ".join([*words[:12], "y", "z"]))]) == {1: 1, 2: 1}  # 8 of 10


def test_names_and_nothing(spark):
    df = spark.createDataFrame([(1, "Red Widget"), (2, "red widgets"), (3, "blue bolt"), (4, None), (5, ""), (None, "red widget")], "id long, name string")
    got = {r.id: r.group_id for r in similarity.near_duplicate_groups(df, "id", similarity.character_runs("name")).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4}
    assert similarity.near_duplicate_groups(df.limit(0), "id", similarity.character_runs("name")).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 400)] + [(700, 700), (650, 600), (600, 650)]
    got = {r.node: r.root for r in graphs.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(100, 400), 100), 700: 700, 650: 600, 600: 600}
