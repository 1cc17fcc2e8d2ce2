"""Limits, paths and refreshes where parents are missing, chains are long or rows vanish."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from martlens.operators import joins, sentiment, topk
from martlens.plans import dashboards
from martlens.streaming import rollups

T0 = dt.datetime(2024, 1, 1)


def products(spark, *ids):
    return spark.createDataFrame([(i, f"p{i}") for i in ids], "product_id bigint, name string")


def test_orphans_on_top_do_not_use_up_the_limit(spark):
    rows = [(i, i % 2, "u", 5, "c", T0 + dt.timedelta(days=i)) for i in range(6)]
    reviews = spark.createDataFrame(rows, "review_id bigint, product_id bigint, user_name string, rating int, comment string, created_at timestamp")
    got = topk.newest_reviews(reviews, products(spark, 0), 2).collect()
    assert sorted(r.review_id for r in got) == [2, 4]
    assert [r.product_id for r in dashboards.most_reviewed(products(spark, 0), reviews, 1).collect()] == [0]
    scored = spark.createDataFrame([(i, "positive", T0 + dt.timedelta(days=i)) for i in (3, 50, 60)], "review_id bigint, sentiment string, processed_at timestamp")
    assert [r.review_id for r in topk.newest_scored(reviews, scored, 1).collect()] == [3]
    now = F.lit("2024-01-07").cast("timestamp")
    assert [r.product_id for r in dashboards.trending(products(spark, 0), reviews, now, n=1).collect()] == [0]


def test_price_reports_keep_n_known_products(spark):
    rows = [(p, 100 - d, 200, d, T0) for p, d in ((1, 10), (2, 90))] + [(p, 50, 200, 0, T0 - dt.timedelta(days=1)) for p in (1, 2)]
    prices = spark.createDataFrame(rows, "product_id bigint, price int, original_price int, discount_percent int, timestamp timestamp")
    assert [r.product_id for r in dashboards.biggest_discounts(products(spark, 1), prices, 1).collect()] == [1]
    assert [r.product_id for r in dashboards.most_volatile(products(spark, 1), prices, 1).collect()] == [1]


def test_paths_of_any_depth_and_circles(spark):
    chain = [(i, f"c{i}", i - 1 if i else None) for i in range(15)]
    ring = [(20, "a", 21), (21, "b", 22), (22, "c", 20), (30, "in", 20), (40, "lost", 99)]
    tree = spark.createDataFrame(chain + ring, "category_id int, category_name string, parent_id int")
    got = {r.category_id: r for r in joins.category_paths(tree).collect()}
    assert len(got) == 20
    assert (got[14].depth, got[14].complete, got[14].path) == (15, True, " / ".join(f"c{i}" for i in range(15)))
    assert [got[i].complete for i in (20, 21, 22, 30)] == [False] * 4
    assert (got[40].path, got[40].complete) == ("lost", True)
    # every category of a chain once, also where the chain leads into a circle
    assert (got[20].path, got[30].path) == ("c / b / a", "c / b / a / in")
    assert joins.category_paths(tree.limit(0)).count() == 0


def test_paths_take_as_many_rounds_as_doubling_needs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(joins, "work_dir", lambda *_: str(tmp_path / "rounds"))
    chain = [(i, f"c{i}", i - 1 if i else None) for i in range(300)]
    rows = joins.category_paths(spark.createDataFrame(chain, "category_id int, category_name string, parent_id int"))
    assert rows.filter("complete").agg(F.max("depth")).first()[0] == 300
    # 2^9 > 300; one folder for each round and one to begin with
    assert len(list((tmp_path / "rounds").iterdir())) == 10


def test_a_day_that_comes_out_empty_is_removed(spark, tmp_path):
    at = [(1, 10.0, dt.datetime(2024, 1, d, 5)) for d in (8, 9, 10)]
    schema = "product_id bigint, price double, timestamp timestamp"
    path = str(tmp_path / "rollup")
    from martlens.operators import prices as P

    rollups.write_rollup(P.hourly_rollup(spark.createDataFrame(at, schema)), path)
    corrected = spark.createDataFrame([at[0], at[2]], schema)
    rollups.refresh_stored(corrected, path, F.lit("2024-01-11").cast("timestamp"))
    days = {r.bucket.day for r in spark.read.parquet(path).collect()}
    assert days == {8, 10}


class TooFew:
    def predict(self, texts):
        return [("label_1", 0.9)] * (len(texts) - 1)


def test_a_model_that_answers_too_little_is_neutral(spark):
    rows = spark.createDataFrame([("good",), ("fine",), (None,)], "comment string")
    got = sentiment.score_with_model(rows, TooFew).collect()
    assert {(r.sentiment, r.confidence) for r in got} == {("neutral", 0.0)}


def test_expired_periods_leave_the_disk(spark, tmp_path):
    rows = [(1, 5.0, dt.datetime(2024, m, 15)) for m in (1, 2, 3, 4)]
    path = str(tmp_path / "history")
    rollups.write_history(spark.createDataFrame(rows, "product_id bigint, price double, timestamp timestamp"), path, "month")
    rollups.drop_expired(spark, path, F.lit("2024-04-20").cast("timestamp"), 60, "month")
    assert sorted(p.name for p in (tmp_path / "history").glob("price_period=*")) == [
        "price_period=2024-02-01", "price_period=2024-03-01", "price_period=2024-04-01",
    ]
