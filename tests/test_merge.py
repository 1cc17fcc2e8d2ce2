"""Merge policies, first-wins, placeholders and duplicates on small fixtures."""

from __future__ import annotations

import json
import random
from collections import defaultdict

from pyspark.sql import functions as F

from martlens import schemas
from martlens.operators import merge
from martlens.sources import messages

def as_of():
    return F.lit("2024-06-01 00:00:00").cast("timestamp")


def product_messages(spark, items):
    rows = [(i, json.dumps(x)) for i, x in enumerate(items)]
    raw = spark.createDataFrame(rows, "seq bigint, value string")
    return messages.decoded(messages.json_messages(raw, schemas.PRODUCT_MESSAGE))


STORED = "product_id bigint, name string, url string, rating decimal(3,2), sold_count int, first_seen timestamp, last_updated timestamp"


def test_present_policy(spark):
    stored = spark.createDataFrame([(1, "old", "u", None, 7, None, None)], STORED)
    sent = product_messages(
        spark,
        [
            {"product_id": 1, "name": "new", "sold_count": 9},
            {"product_id": 1, "sold_count": None},
            {"product_id": 2, "name": "b", "url": "v", "rating": 4.5},
        ],
    )
    rows = {r.product_id: r for r in merge.upsert_products(stored, sent, as_of()).collect()}
    # the absent name of the second message keeps the first's; its null count replaces 9
    assert (rows[1]["name"], rows[1].url, rows[1].sold_count) == ("new", "u", None)
    assert rows[1].first_seen is None and str(rows[1].last_updated) == "2024-06-01 00:00:00"
    assert (rows[2]["name"], float(rows[2].rating), rows[2].sold_count) == ("b", 4.5, 0)
    assert rows[2].first_seen is not None


def test_truthy_policy(spark):
    updates = spark.createDataFrame([(1, 0, 5, "a"), (1, 1, 0, ""), (1, 2, None, None)], "k int, seq int, n int, s string")
    row = merge.fold_updates(updates, "k", ["n", "s"], "truthy").first()
    assert (row.n, row.s) == (5, "a")


def test_present_fold_equals_replay_message_by_message(spark):
    rnd = random.Random(5)
    items = []
    for _ in range(300):
        item = {"product_id": rnd.choice([1, 1, 1, 2, 3]), "name": "n"}
        for key in ("url", "rating", "sold_count"):
            draw = rnd.random()
            if draw < 0.6:
                item[key] = None if draw < 0.2 else {"url": "u%d" % rnd.randrange(9), "rating": rnd.randrange(5), "sold_count": rnd.randrange(99)}[key]
        items.append(item)
    state = defaultdict(dict)
    for item in items:
        state[item["product_id"]].update(item)
    stored = spark.createDataFrame([], STORED)
    got = merge.upsert_products(stored, product_messages(spark, items), as_of()).collect()
    for r in got:
        want = state[r.product_id]
        assert r.url == want.get("url")
        assert r.sold_count == want.get("sold_count", 0)
        assert (None if r.rating is None else float(r.rating)) == want.get("rating")


def test_merge_without_insert_ignores_unknown_keys_and_stamps_changes_only(spark):
    stored = spark.createDataFrame([(1, "a", None), (2, "b", None)], "k int, v string, t timestamp")
    updates = spark.createDataFrame([(1, 0, "a"), (2, 0, "c"), (9, 0, "z")], "k int, seq int, v string")
    got = merge.merge_rows(stored, updates, "k", ["v"], "overwrite", as_of=as_of(), touched="t", insert=False, touch_always=False)
    assert sorted((r.k, r.v, r.t is not None) for r in got.collect()) == [(1, "a", False), (2, "c", True)]


def test_merging_twice_changes_nothing(spark):
    stored = spark.createDataFrame([(1, "old", "u", None, 7, None, None)], STORED)
    sent = product_messages(spark, [{"product_id": 1, "name": "x"}, {"product_id": 4, "name": "y", "url": "w"}])
    once = merge.upsert_products(stored, sent, as_of())
    twice = merge.upsert_products(once, sent, as_of())
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_prices_skip_falsy_and_recorded(spark):
    history = spark.createDataFrame([(1, "2024-01-01")], "product_id bigint, d string").select(
        "product_id", F.lit(5).cast("decimal(12,2)").alias("price"), F.lit(None).cast("decimal(12,2)").alias("original_price"),
        F.lit(0).alias("discount_percent"), F.lit(1).alias("stock_available"), F.col("d").cast("timestamp").alias("timestamp"),
    )
    sent = product_messages(
        spark,
        [
            {"product_id": 1, "price": 99, "crawled_at": "2024-01-01"},
            {"product_id": 1, "price": 0, "crawled_at": "2024-01-02"},
            {"product_id": 1, "price": 7, "crawled_at": "2024-01-03"},
            {"product_id": 1, "price": 8, "crawled_at": "2024-01-03"},
        ],
    ).withColumn("timestamp", F.col("crawled_at").cast("timestamp"))
    got = merge.append_prices(history, sent)
    assert sorted((str(r.timestamp)[:10], float(r.price)) for r in got.collect()) == [("2024-01-01", 5.0), ("2024-01-03", 7.0)]


def test_first_wins_with_a_hot_key(spark):
    rows = [(7, i, f"v{i}") for i in range(500, 0, -1)] + [(8, 3, "x"), (8, 2, "y")]
    df = spark.createDataFrame(rows, "id bigint, seq bigint, v string").repartition(7)
    assert sorted(map(tuple, merge.first_wins(df, "id").collect())) == [(7, 1, "v1"), (8, 2, "y")]
    stored = spark.createDataFrame([(7,)], "id bigint")
    assert [tuple(r) for r in merge.new_rows(df, stored, "id").collect()] == [(8, 2, "y")]


def test_shops(spark):
    shops = spark.createDataFrame([(1, "One", True), (2, "Two", False)], "shop_id bigint, shop_name string, is_official boolean")
    details = spark.createDataFrame(
        [(1, "", 0), (2, "Zwei", 1), (3, None, 2), (4, "Four", 3), (0, "none", 4)], "shop_id bigint, shop_name string, seq bigint"
    )
    got = sorted(map(tuple, merge.upsert_shops(shops, details).collect()))
    assert got == [(1, "One", True), (2, "Zwei", False), (3, "Shop 3", False), (4, "Four", False)]
    added = sorted(map(tuple, merge.ensure_shops(shops, details).collect()))
    assert added == [(1, "One", True), (2, "Two", False), (3, "Shop 3", False), (4, "Shop 4", False)]


def test_duplicates(spark):
    rows = [(1, "A  b"), (2, "a b "), (3, "c"), (4, None), (5, None)]
    df = spark.createDataFrame(rows, "id bigint, t string")
    assert sorted((r.kept_id, r.copies) for r in merge.duplicate_groups(df, "id", "t").collect()) == [(1, 2), (3, 1)]
    assert sorted(r.id for r in merge.without_duplicates(df, "id", "t").collect()) == [1, 3, 4, 5]
