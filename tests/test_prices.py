"""Price history on hand-made rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from martlens.functions.ordered import as_of_join
from martlens.operators import joins, prices as P
from martlens.streaming import rollups


def history(spark, rows):
    df = spark.createDataFrame([(p, t, str(v)) for p, t, v in rows], "product_id int, t string, v string")
    return df.select(
        "product_id", F.col("v").cast("decimal(12,2)").alias("price"), F.col("t").cast("timestamp").alias("timestamp")
    )


def at(text):
    return F.lit(text).cast("timestamp")


ROWS = [(1, "2024-01-01 10:00", 10), (1, "2024-01-02 10:00", 20), (1, "2024-01-02 11:00", 20), (1, "2024-01-05 09:00", 30)]


@pytest.fixture
def products(spark):
    return spark.createDataFrame([(1, "one"), (2, "two")], "product_id int, name string")


def moves(df):
    return sorted((float(r.current_price), float(r.previous_price), r.price_change_percent) for r in df.collect())


def test_chronological_changes(spark, products):
    got = P.price_changes(products, history(spark, ROWS), at("2024-01-06"), 7, "chronological")
    assert moves(got) == [(20.0, 10.0, 100.0), (30.0, 20.0, 50.0)]


def test_reference_order_compares_with_the_following_price(spark, products):
    got = P.price_changes(products, history(spark, ROWS), at("2024-01-06"), 7, "reference")
    assert moves(got) == [(10.0, 20.0, -50.0), (20.0, 30.0, -33.33)]


def test_rows_before_the_period_are_no_predecessors(spark, products):
    got = P.price_changes(products, history(spark, ROWS), at("2024-01-06"), 2, "chronological")
    assert moves(got) == []


@pytest.mark.parametrize("width", ["hour", "day", "year"])
def test_slices_do_not_change_the_result(spark, products, width):
    rows = [(1 if i % 3 else 2, f"2024-01-{1 + i % 28:02d} {i % 24:02d}:{i % 60:02d}", i * 37 % 11) for i in range(200)]
    rows = list({(p, t): (p, t, v) for p, t, v in rows}.values())
    got = P.price_changes(products, history(spark, rows), at("2024-02-01"), 60, "chronological", width)
    want = []
    for key in (1, 2):
        group = sorted((t, v) for p, t, v in rows if p == key)
        want += [(float(b), float(a)) for (_, a), (_, b) in zip(group, group[1:]) if a != b]
    assert sorted((c, p) for c, p, _ in moves(got)) == sorted(want)


def test_latest_price_as_of(spark):
    df = history(spark, ROWS)
    assert float(joins.latest_price(df).first().price) == 30
    assert float(joins.latest_price(df, at("2024-01-04")).first().price) == 20
    assert joins.latest_price(df, at("2023-01-01")).count() == 0


def test_refresh_keeps_what_is_out_of_range(spark):
    old = P.hourly_rollup(history(spark, [(1, "2024-01-01 10:15", 1), (1, "2024-01-09 10:15", 1)]))
    rows = [
        (1, "2024-01-01 10:15", 1),
        (1, "2024-01-01 10:45", 99),  # late: too old to change its bucket
        (1, "2024-01-09 10:15", 1),
        (1, "2024-01-09 10:45", 5),  # in range
        (1, "2024-01-10 11:30", 7),  # newer than the range
    ]
    got = P.refresh_rollup(old, history(spark, rows), at("2024-01-10 12:00"))
    cells = sorted((str(r.bucket), float(r.max_price), r.price_changes) for r in got.collect())
    assert cells == [("2024-01-01 10:00:00", 1.0, 1), ("2024-01-09 10:00:00", 5.0, 2)]


def test_stored_refresh_rewrites_touched_days_only(spark, tmp_path):
    import os
    import time

    rows = [(1, f"2024-01-{d:02d} {h:02d}:30", d) for d in range(1, 11) for h in (1, 13, 23)]
    path = str(tmp_path / "rollup")
    stale = [r for r in rows if "13:30" not in r[1]]
    rollups.write_rollup(P.hourly_rollup(history(spark, stale)), path)
    stamp = {d: os.path.getmtime(f"{path}/{d}") for d in os.listdir(path) if d.startswith("bucket")}
    time.sleep(0.05)
    as_of = at("2024-01-10 12:00")
    rollups.refresh_stored(history(spark, rows), path, as_of)
    got = spark.read.parquet(path).drop("bucket_period")
    want = P.refresh_rollup(P.hourly_rollup(history(spark, stale)), history(spark, rows), as_of)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    touched = {d for d in stamp if os.path.getmtime(f"{path}/{d}") != stamp[d]}
    assert touched == {f"bucket_period=2024-01-{d:02d}" for d in (7, 8, 9, 10)}


def test_filled_series(spark):
    got = P.filled_series(history(spark, ROWS)).orderBy("period").collect()
    assert [(str(r.period)[:10], float(r.price), r.filled) for r in got] == [
        ("2024-01-01", 10, False), ("2024-01-02", 20, False), ("2024-01-03", 20, True),
        ("2024-01-04", 20, True), ("2024-01-05", 30, False),
    ]


def test_retention(spark):
    assert P.retained(history(spark, ROWS), at("2024-04-01 10:00"), 90).count() == 3


def test_refresh_of_changed_days_reads_and_writes_only_those(spark, tmp_path):
    kept = rollups.StoredRollup(spark, str(tmp_path))
    kept.add(history(spark, ROWS), 0)
    kept.refresh(-1, 0)
    late = [(1, "2024-01-02 10:00", 26), (1, "2024-01-02 12:00", 8), (2, "2024-01-02 10:30", 4)]
    for _ in range(2):  # the second time as after a crash
        kept.add(history(spark, late), 1)
        kept.refresh(0, 1)
    want = [r for r in ROWS if r[:2] != late[0][:2]] + late
    same = lambda df: sorted(map(str, df.select(F.col("product_id").cast("int"), "bucket", "avg_price", "min_price", "max_price", "price_changes").collect()))
    assert same(kept.rollup()) == same(P.hourly_rollup(history(spark, want)))
    assert {r.period.day for r in kept.changed(0, 1).select("period").distinct().collect()} == {2}
    plan = kept.changed(0, 1)._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: ")[1].split("]")[0]
    assert "period" in filters and "2024-01-02" in filters and "2024-01-05" not in filters
    days = kept.rollup("day").where("bucket = '2024-01-02'").orderBy("product_id").collect()
    assert [(float(r.avg_price), float(r.min_price), r.price_changes) for r in days] == [(18.0, 8.0, 3), (4.0, 4.0, 1)]


def test_withdrawn_prices_leave_no_day_behind(spark, tmp_path):
    kept = rollups.StoredRollup(spark, str(tmp_path))
    kept.add(history(spark, ROWS), 0)
    kept.refresh(-1, 0)
    kept.add(history(spark, [(1, "2024-01-05 09:00", 1)]).withColumn("price", F.lit(None).cast("decimal(12,2)")), 1)
    kept.refresh(0, 1)
    assert sorted(r.bucket.day for r in kept.rollup().collect()) == [1, 2, 2]


def test_prices_in_force_at_each_time(spark):
    asked = spark.createDataFrame(
        [(1, 1, "2024-01-01 09:00"), (2, 1, "2024-01-01 10:00"), (3, 1, "2024-03-01"), (4, 1, "2024-01-02 10:30"), (5, 2, "2024-01-09"), (6, 1, None), (7, None, "2024-01-09")],
        "id int, product_id int, t string",
    )
    rows = as_of_join(asked.withColumn("at", F.col("t").cast("timestamp")), history(spark, ROWS), "product_id", "at", "timestamp", ["price"], "day")
    got = {r.id: None if r.price is None else float(r.price) for r in rows.collect()}
    assert got == {1: None, 2: 10.0, 3: 30.0, 4: 20.0, 5: None, 6: None, 7: None}
    assert rows.columns == ["id", "product_id", "t", "at", "price"]
