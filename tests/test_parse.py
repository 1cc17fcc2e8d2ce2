"""Parsers on hand-made payloads."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from martlens import schemas
from martlens.functions import scalars as X
from martlens.operators import parse
from martlens.sources import messages

def now():
    return F.lit("2030-01-01 00:00:00").cast("timestamp")


def one(spark, payload, column="element"):
    return spark.createDataFrame([(json.dumps(payload, ensure_ascii=False),)], f"{column} string")


ITEM = {
    "id": 51,
    "name": " Copper Kettle & Lid ",
    "url_path": "kettle.html?v=52",
    "thumbnail_url": "https://pics.example/k.png",
    "short_description": "",
    "price": 8400,
    "original_price": 12000,
    "discount_rate": 30,
    "rating_average": 0,
    "seller": None,
    "seller_id": 1,
    "quantity_sold": {"text": "7 sold", "value": 7},
    "availability": 1,
    "primary_category_path": "9/41/417",
}


def test_listing_item(spark):
    row = parse.accepted(parse.listing_products(one(spark, ITEM), site="https://s/")).first()
    assert row.asDict() == {
        "item_type": "product",
        "product_id": 51,
        "name": "Copper Kettle & Lid",
        "url": "https://s/kettle.html?v=52",
        "image_url": "https://pics.example/k.png",
        "description": "",
        "shop_id": 1,
        "category_id": 417,
        "rating": 0.0,
        "sold_count": 7,
        "price": 8400.0,
        "original_price": 12000.0,
        "discount_percent": 30,
        "stock_available": 1,
    }


def test_missing_and_null_differ(spark):
    missing = {k: v for k, v in ITEM.items() if k not in ("name", "price")}
    assert parse.accepted(parse.listing_products(one(spark, missing))).first().price == 0.0
    null = {**ITEM, "name": None, "price": None}
    assert parse.rejected(parse.listing_products(one(spark, null))).first().problems == ["name", "price"]


@pytest.mark.parametrize(
    "change, shop_id",
    [({}, 1), ({"seller": {"id": 9, "name": "x"}}, 9), ({"seller": {"name": "x"}}, 0), ({"seller": {}}, 1)],
)
def test_listing_shop(spark, change, shop_id):
    assert parse.listing_products(one(spark, {**ITEM, **change})).first().shop_id == shop_id


@pytest.mark.parametrize("path, want", [("1/2/x", None), ("77", 77), ("", None), ("1/ 5 ", 5)])
def test_path_tail(spark, path, want):
    df = spark.createDataFrame([(path,)], "p string").select(X.path_tail_int("p").alias("v"))
    assert df.first().v == want


def test_shop_items(spark):
    official = {"visible_impression_info": {"amplitude": {"seller_type": "OFFICIAL_STORE"}}}
    with_shop = {**ITEM, "seller": {"id": 5, "name": " Best "}, **official}
    row = parse.shop_items(one(spark, with_shop)).first()
    assert (row.shop_id, row.shop_name, row.is_official) == (5, "Best", True)
    assert parse.shop_items(one(spark, ITEM)).count() == 0


def test_review_detail(spark):
    body = {
        "id": 7, "product_id": 3, "title": "T", "content": "", "rating": 5, "thank_count": 2, "images": [{"id": 1}],
        "created_at": 1709210096, "created_by": {"id": 11, "name": "n", "full_name": ""},
    }
    row = parse.review_details(one(spark, body, "value"), now()).first()
    assert (row.user_name, row.comment, row.has_images, row.helpful_count) == ("n", "T", True, 2)
    assert row.created_at == dt.datetime(2024, 2, 29, 12, 34, 56)
    assert row.customer_id == 11


@pytest.mark.parametrize(
    "text, want",
    [
        ("1709210096", "2024-02-29 12:34:56"),
        ("99999999999999", "2030-01-01 00:00:00"),
        ("2024-05-06T07:08:09Z", "2024-05-06 07:08:09"),
        ("2024-05-06T07:08:09.25+01:00", "2024-05-06 06:08:09.25"),
        ("yesterday", "2030-01-01 00:00:00"),
        (None, "2030-01-01 00:00:00"),
    ],
)
def test_moment(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string").select(X.moment("t", now()).cast("string").alias("v"))
    assert df.first().v == want


@pytest.mark.parametrize(
    "html, want",
    [("<p>a\n <b>b</b>&nbsp;</p>", "a b&nbsp;"), (None, ""), ("a < b > c", "a c"), ("x  y<br/>", "x y")],
)
def test_strip_html(spark, html, want):
    df = spark.createDataFrame([(html,)], "h string").select(X.strip_html("h").alias("v"))
    assert df.first().v == want


def test_detail_falsy_values_are_null(spark):
    body = {"id": 1, "name": "", "url_path": "d/1", "description": "<p>x</p>", "rating_average": 0, "review_count": 0, "authors": []}
    row = parse.product_details(one(spark, body, "value"), site="https://s/").first()
    assert (row["name"], row.url, row.description) == (None, "https://s/d/1", "x")
    assert (row.rating, row.review_count, row.authors) == (None, None, None)


def test_star_histogram(spark):
    body = {"stars": {"5": {"count": 9, "percent": 90}, "1": {"count": 1, "percent": 10}}}
    rows = parse.star_histogram(one(spark, body, "value")).collect()
    assert sorted(map(tuple, rows)) == [(1, 1, 10), (5, 9, 90)]


def test_messages_keep_what_cannot_be_decoded(spark):
    texts = ['{"a": 1}', '{"a": null}', "{}", "{bad", "[1]", "3", None]
    raw = spark.createDataFrame(list(enumerate(texts)), "seq int, value string")
    read = messages.json_messages(raw, "a INT")
    assert sorted((r.seq, r.a, r.present) for r in messages.decoded(read).collect()) == [
        (0, 1, ["a"]), (1, None, ["a"]), (2, None, []),
    ]
    assert sorted(r.value for r in messages.corrupt(read).collect()) == ["", "3", "[1]", "{bad"]


def test_filter_on_parsed_column_does_not_parse_twice(spark):
    read = messages.json_messages(spark.createDataFrame([(1, "{}")], "seq int, value string"), "a INT")
    plan = messages.decoded(read)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_keyed_messages_write_nulls(spark):
    df = spark.createDataFrame([(1, None)], "id bigint, x string")
    assert tuple(messages.keyed(df, "id").first()) == ("1", '{"id":1,"x":null}')


def test_request_defaults(spark):
    df = spark.createDataFrame([(5, None, 0), (6, 7, 8)], "product_id bigint, spid bigint, seller_id bigint")
    assert sorted(map(tuple, parse.review_requests(df).collect())) == [(5, 5, 1), (6, 7, 8)]
    assert schemas.STAGE_TOPICS
