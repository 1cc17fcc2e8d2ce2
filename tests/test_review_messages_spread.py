"""Review messages are dealt to many tasks, and a review that is known to be the only one is not looked for again."""

from __future__ import annotations

from pyspark.sql import functions as F

from martlens.operators import derive, parse
from martlens.plans import sample_messages
from martlens.plans.sample_model import SampleModel


def test_review_messages_are_spread_before_they_are_made(spark):
    rows = sample_messages.review_messages(SampleModel(spark, "/root/testdata/sf0.001"))
    plan = rows._jdf.queryExecution().optimizedPlan().toString().splitlines()
    dealt = next(k for k, line in enumerate(plan) if "RepartitionByExpression" in line)
    assert dealt > next(k for k, line in enumerate(plan) if "Generate" in line)


def test_orders_of_single_reviews_are_not_grouped_by_review(spark):
    columns = "seq BIGINT, review_id BIGINT, product_id BIGINT, customer_id BIGINT, order_date TIMESTAMP"
    given = spark.createDataFrame([(1, 1, 5, 9, None), (2, 2, 5, None, None), (3, 3, 6, 9, None)], columns)
    prices = spark.createDataFrame([(5, 20, None)], "product_id BIGINT, price INT, timestamp TIMESTAMP")
    made = [derive.order_facts(given, prices.select("product_id"), prices, once=once) for once in (False, True)]
    assert made[0].collect() == made[1].collect() and [r.order_id for r in made[1].collect()] == [1]
    groups = [sum("Aggregate [review_id" in line for line in m._jdf.queryExecution().optimizedPlan().toString().splitlines()) for m in made]
    assert groups == [1, 0]


def test_unreadable_messages_are_told_by_the_one_reading(spark):
    rows = spark.createDataFrame([(1, '{"id": 1}'), (2, "[1]"), (3, '{"id"'), (4, None), (5, "{}")], "seq BIGINT, value STRING")
    read = parse.review_details(rows, F.lit(None).cast("timestamp"), unreadable="bad")
    assert {r.seq: r.bad for r in read.collect()} == {1: False, 2: True, 3: True, 4: True, 5: False}
