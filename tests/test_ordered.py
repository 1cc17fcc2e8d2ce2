"""Sliced windows against plain Python, with one group that holds most of the rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from martlens.functions import ordered


def skewed(n=400, seed=1):
    rnd = random.Random(seed)
    rows = set()
    while len(rows) < n:
        rows.add(("hot" if rnd.random() < 0.8 else f"k{rnd.randrange(5)}", rnd.randrange(5000)))
    return [(k, v, rnd.choice([None, 1, 2, 3])) for k, v in sorted(rows)]


@pytest.mark.parametrize("towards", ["previous", "next"])
def test_neighbour(spark, towards):
    rows = skewed()
    df = spark.createDataFrame(rows, "k string, v int, x int")
    got = ordered.with_neighbour(df, ["k"], "v", ["x", "v"], F.floor(F.col("v") / 37), towards, "near_")
    want = []
    for key in {k for k, _, _ in rows}:
        group = sorted((r for r in rows if r[0] == key), key=lambda r: r[1], reverse=towards == "next")
        for before, row in zip([None, *group], group):
            want.append((*row, *((before[2], before[1]) if before else (None, None))))
    order = lambda r: (r[0], r[1])
    assert sorted(map(tuple, got.collect()), key=order) == sorted(want, key=order)


@pytest.mark.parametrize("bits", [2, 5, 13])
def test_total_before(spark, bits):
    rows = [(k, v, (v % 7) + 1) for k, v, _ in skewed()]
    df = spark.createDataFrame(rows, "k string, v bigint, w bigint")
    got = ordered.with_total_before(df, ["k"], "v", "w", "before", slice_bits=bits, value_bits=13)
    want = {(k, v): sum(w2 for k2, v2, w2 in rows if k2 == k and v2 < v) for k, v, w in rows}
    assert {(r.k, r.v): r.before for r in got.collect()} == want


def test_row_number_over_whole_table(spark):
    ids = sorted(random.Random(3).sample(range(1 << 40), 300))
    df = spark.createDataFrame([(i,) for i in ids], "id bigint")
    got = ordered.with_row_number(df, [], "id", slice_bits=8, value_bits=40)
    assert {r.id: r.row_number for r in got.collect()} == {x: i + 1 for i, x in enumerate(ids)}


def test_exact_percentiles(spark):
    rows = [(k, v % 50) for k, v, _ in skewed()] + [("one", 9)]
    df = spark.createDataFrame(rows, "k string, v bigint")
    got = ordered.exact_percentiles(df, ["k"], "v", {"p10": 0.1, "median": 0.5, "p99": 0.99})
    want = df.groupBy("k").agg(*[F.percentile("v", F.lit(p)).alias(n) for n, p in (("p10", 0.1), ("median", 0.5), ("p99", 0.99))])
    a = {r.k: (r.p10, r.median, r.p99) for r in got.collect()}
    b = {r.k: (r.p10, r.median, r.p99) for r in want.collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k])


def test_top_per_group_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    top = ordered.top_per_group(df, ["k"], [F.desc("id")], 2)
    assert sorted((r.k, r.id) for r in top.collect()) == [(0, 996), (0, 999), (1, 994), (1, 997), (2, 995), (2, 998)]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 2, Partial" in plan
