"""The streaming stages: batches in several files, replays, crashes and late data."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from martlens.operators import prices as P
from martlens.sources import files, messages
from martlens.sources.messages import LANDED
from martlens.sources.tables import MERGE, LogTable
from martlens.streaming import rollups
from martlens.streaming.stages import Stages


def land(spark, root, name, items):
    rows = [(i, str(k), x if isinstance(x, str) else json.dumps(x)) for i, k, x in items]
    spark.createDataFrame(rows, "seq BIGINT, key STRING, value STRING").coalesce(1).write.mode("append").json(f"{root}/in/{name}")


def stream(spark, root, name):
    return messages.read_stream(spark, "json", {}, f"{root}/in/{name}")


def stream_rows(spark, root, name):
    return messages.landed(spark.read.schema(LANDED).json(f"{root}/in/{name}"))


def product(i, **more):
    return {"item_type": "product", "product_id": i, "name": f"p{i}", "url": "u", "shop_id": 5, "price": 100 + i,
            "crawled_at": "2024-01-01T00:00:00", **more}


def review(i, product_id, **more):
    return {"id": i, "product_id": product_id, "content": "good", "rating": 5, "created_at": 1700000000 + i,
            "created_by": {"id": 900 + i, "name": "N"}, **more}


@pytest.fixture
def stages(spark, tmp_path):
    root = str(tmp_path)
    made = Stages(spark, root).create()
    land(spark, root, "products", [(1, 1, product(1)), (2, 2, product(2)), (3, 3, product(3, name="")), (4, "x", "{bad")])
    made.run(stream(spark, root, "products"), made.on_products, "products")
    return made


def snapshot(stages):
    out = {}
    for t in (stages.reviews, stages.orders, stages.order_lines, stages.customers, stages.sentiment, stages.rejects, stages.metrics):
        out[t.path] = sorted(map(str, t.current().collect()))
    return out


def test_products(stages):
    assert sorted((r.product_id, r["name"]) for r in stages.products.current().collect()) == [(1, "p1"), (2, "p2")]
    assert [r.shop_name for r in stages.shops.current().collect()] == ["Shop 5"]
    assert sorted(float(r.price) for r in stages.prices.current().collect()) == [101.0, 102.0]
    assert sorted(r.reason for r in stages.rejects.current().collect()) == ["name_length", "not a JSON object"]
    bodies = sorted(r.value for r in stages.topics["product-detail"].current().collect())
    assert bodies == ['{"product_id":1,"spid":1}', '{"product_id":2,"spid":2}']


def test_details_win_over_listing_by_message_order(spark, stages):
    detail = {"id": 1, "name": "full", "description": "<i>d</i>", "current_seller": {"id": 5, "name": "Best"}, "review_count": 4}
    land(spark, stages.root, "details", [(10, 1, detail), (11, 7, {"name": "no id"})])
    stages.run(stream(spark, stages.root, "details"), stages.on_details, "details")
    land(spark, stages.root, "products", [(12, 1, product(1, name="listed again"))])
    stages.run(stream(spark, stages.root, "products"), stages.on_products, "products")
    row = stages.products.current().filter("product_id = 1").first()
    assert (row["name"], row.description, row.review_count) == ("listed again", "d", 4)
    assert stages.shops.current().first().shop_name == "Best"
    assert "missing product_id" in [r.reason for r in stages.rejects.current().collect()]
    assert stages.topics["review-fetch"].current().first().value == '{"product_id":1,"spid":1,"seller_id":5}'


def test_reviews_in_two_batches_first_wins_and_replay_changes_nothing(spark, stages):
    root = stages.root
    first = [(20, 1, review(1, 1)), (21, 2, review(2, 2, rating=0)), (22, 3, review(3, 99)), (23, 4, review(4, 2, content=""))]
    land(spark, root, "reviews", first)
    stages.run(stream(spark, root, "reviews"), stages.on_reviews, "reviews")
    land(spark, root, "reviews", [(30, 1, review(1, 1, content="bad", rating=1)), (31, 5, review(5, 1)), (32, 5, review(5, 1, rating=2))])
    stages.run(stream(spark, root, "reviews"), stages.on_reviews, "reviews")
    rows = {r.review_id: r for r in stages.reviews.current().collect()}
    assert sorted(rows) == [1, 4, 5] and rows[1].comment == "good" and rows[5].rating == 5
    orders = {r.review_id: r for r in stages.orders.current().collect()}
    assert sorted(orders) == [1, 4, 5] and float(orders[4].total_amount) == 102.0
    labels = {r.review_id: r.sentiment for r in stages.sentiment.current().collect()}
    assert labels == {1: "positive", 4: "neutral", 5: "positive"}
    reasons = sorted((json.loads(r.value)["id"], r.reason) for r in stages.rejects.current().filter("stage = 'reviews'").collect())
    assert reasons == [(2, "rating out of range"), (3, "unknown product")]

    before = snapshot(stages)
    # the second batch again, as after a crash between its writes and its commit
    again = messages.landed(spark.read.schema(LANDED).json(f"{root}/in/reviews").filter("seq >= 30"))
    stages.on_reviews(again, 1)
    assert snapshot(stages) == before


def test_review_pages(spark, stages):
    page = {"data": [review(8, None), review(9, None)], "paging": {"last_page": 1}}
    land(spark, stages.root, "pages", [(40, 2, page)])
    stages.run(stream(spark, stages.root, "pages"), stages.on_review_pages, "pages")
    sent = stages.topics["review-detail"].current()
    stages.on_reviews(sent, 0)
    assert sorted((r.review_id, r.product_id) for r in stages.reviews.current().collect()) == [(8, 2), (9, 2)]


def test_no_page_is_lost(spark, stages):
    page = {"data": [review(8, None)], "paging": {"last_page": 1}}
    bad = [(41, 2, '{"data": ['), (42, 2, {"data": None}), (43, "abc", page), (44, 2, "[]")]
    land(spark, stages.root, "pages", [(40, 2, page), *bad])
    stages.run(stream(spark, stages.root, "pages"), stages.on_review_pages, "pages")
    refused = {r.seq["at"]: (r.reason, r.value) for r in stages.rejects.current().filter("stage = 'review_pages'").collect()}
    assert {k: v[0] for k, v in refused.items()} == {
        41: "not a JSON object", 42: "no list of reviews", 43: "key is not a product id", 44: "not a JSON object",
    }
    assert refused[41][1] == '{"data": [' and json.loads(refused[43][1]) == page
    counts = stages.metrics.current().filter("stage = 'review_pages'").first()
    assert (counts.processed, counts.failed) == (1, 4)


def test_unreadable_messages_keep_their_body(spark, stages):
    for name, stage in (("details", stages.on_details), ("reviews", stages.on_reviews)):
        land(spark, stages.root, name, [(50, 1, "{cut")])
        stages.run(stream(spark, stages.root, name), stage, name)
        row = stages.rejects.current().filter(F.col("stage") == name).first()
        assert (row.value, row.reason) == ("{cut", "not a JSON object")


def test_compaction_of_every_kind_of_log(spark, stages, tmp_path):
    root = stages.root
    land(spark, root, "products", [(12, 1, product(1, name="again", rating=None)), (13, 1, product(1, price=7))])
    stages.run(stream(spark, root, "products"), stages.on_products, "products")
    detail = {"id": 1, "description": "d", "current_seller": {"id": 5, "name": "Best"}, "categories": {"id": 3}}
    land(spark, root, "details", [(14, 1, detail)])
    stages.run(stream(spark, root, "details"), stages.on_details, "details")
    land(spark, root, "reviews", [(20, 1, review(1, 1)), (21, 2, review(2, 1, created_by={"id": 901, "name": "Later"}))])
    stages.run(stream(spark, root, "reviews"), stages.on_reviews, "reviews")
    for table in (stages.products, stages.shops, stages.categories, stages.prices, stages.customers, stages.orders):
        small = table.compact_to(str(tmp_path / "small" / table.path.split("/")[-1]))
        assert sorted(map(str, small.current().collect())) == sorted(map(str, table.current().collect()))
        assert small.log().count() == table.current().count()


def test_kafka_records_become_messages(spark):
    rows = [(b"1", b"{}", 999_999, "2024-01-01 00:00:00.001"), (b"1", b"{}", 1_000_000, "2024-01-01 00:00:00.001"), (None, b"{}", 4, "2024-01-01 00:00:00.002")]
    records = spark.createDataFrame(rows, "key binary, value binary, offset bigint, t string").withColumn("partition", F.lit(3))
    got = messages.from_kafka(records.withColumn("timestamp", F.col("t").cast("timestamp"))).collect()
    assert [(r.key, r.value) for r in got] == [("1", "{}"), ("1", "{}"), (None, "{}")]
    assert got[0].seq < got[1].seq < got[2].seq


def test_compaction_keeps_the_current_rows(spark, stages, tmp_path):
    table = stages.reviews
    row = lambda i, batch: spark.createDataFrame([(i, batch)], "review_id bigint, rating int").withColumn(
        "order_at", F.struct(messages.place(F.lit(batch)).alias("seq"), F.lit(0).alias("stage"), F.lit(batch).cast("bigint").alias("batch"))
    )
    pad = lambda df: df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema])
    for i, batch in ((1, 1), (1, 2), (2, 2)):
        table.append(pad(row(i, batch)), f"s{i}{batch}", batch)
    small = table.compact_to(str(tmp_path / "compact"))
    assert small.log().count() == 2
    assert sorted(map(str, small.current().collect())) == sorted(map(str, table.current().collect()))


def test_replayed_append_is_one_append(spark, tmp_path):
    table = LogTable(spark, str(tmp_path / "t"), "a INT").create()
    df = spark.createDataFrame([(1,), (2,)], "a int")
    for _ in range(3):
        table.append(df, "s", 0)
    assert table.current().count() == 2


def price_files(spark, path, rows):
    df = spark.createDataFrame(rows, "product_id int, price double, t string")
    df.coalesce(1).write.mode("append").json(path)


def price_stream(spark, path):
    raw = spark.readStream.schema("product_id int, price double, t string").option("maxFilesPerTrigger", 1).json(path)
    return raw.select("product_id", F.col("price").cast("decimal(12,2)").alias("price"), F.col("t").cast("timestamp").alias("timestamp"))


def test_streamed_rollup_equals_batch_for_closed_buckets_and_ignores_late_rows(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    rows = [(1, 10.0, "2024-01-01 10:10"), (1, 20.0, "2024-01-01 10:50"), (2, 5.0, "2024-01-02 01:00")]
    price_files(spark, src, rows)
    rollups.write_available(rollups.hourly_rollup_stream(price_stream(spark, src)), out, ckpt)
    price_files(spark, src, [(1, 1.0, "2024-01-20 00:00")])
    rollups.write_available(rollups.hourly_rollup_stream(price_stream(spark, src)), out, ckpt)
    price_files(spark, src, [(1, 99.0, "2024-01-01 10:20")])  # far too late
    rollups.write_available(rollups.hourly_rollup_stream(price_stream(spark, src)), out, ckpt)
    batch = spark.createDataFrame(rows, "product_id int, price double, t string").select(
        "product_id", F.col("price").cast("decimal(12,2)").alias("price"), F.col("t").cast("timestamp").alias("timestamp")
    )
    got = spark.read.parquet(out)
    assert sorted(map(str, got.collect())) == sorted(map(str, P.hourly_rollup(batch).collect()))


def test_stream_dedupe(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    for _ in range(2):
        price_files(spark, src, [(1, 1.0, "2024-01-01 10:10"), (2, 1.0, "2024-01-01 10:11")])
    first = rollups.first_seen_stream(price_stream(spark, src), "product_id", "timestamp")
    rollups.write_available(first, out, ckpt)
    assert sorted(r.product_id for r in spark.read.parquet(out).collect()) == [1, 2]


def test_csv_keeps_null_empty_and_line_breaks(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, 'a "q", b\nline\r\nend\\'), (4, " x "), (5, "\\N?")]
    df = spark.createDataFrame(rows, "id int, t string")
    files.write_csv(df, str(tmp_path / "c"))
    assert sorted(map(tuple, files.read_csv(spark, str(tmp_path / "c"), "id INT, t STRING").collect())) == rows
    files.write_json_lines(df, str(tmp_path / "j"))
    assert sorted(map(tuple, files.read_json_lines(spark, str(tmp_path / "j"), "id INT, t STRING").collect())) == rows


def test_order_sentiment_and_shop_stages(spark, stages):
    root = stages.root
    land(spark, root, "reviews", [(20, 1, review(1, 1))])
    stages.run(stream(spark, root, "reviews"), stages.on_reviews, "reviews")
    before = [sorted(map(str, t.current().collect())) for t in (stages.orders, stages.order_lines, stages.sentiment)]
    stages.on_orders(stages.topics["orders"].current(), 0)
    stages.on_sentiment(stages.topics["sentiment-analysis"].current(), 0)
    assert [sorted(map(str, t.current().collect())) for t in (stages.orders, stages.order_lines, stages.sentiment)] == before
    late = {"review_id": 5, "product_id": 2, "customer_id": 9, "customer_name": "Q", "order_date": "2024-02-03T04:05:06", "rating": 4}
    land(spark, root, "orders", [(30, 5, late), (31, 6, {**late, "review_id": 0}), (32, 7, "{cut")])
    stages.run(stream(spark, root, "orders"), stages.on_orders, "orders")
    assert sorted(r.review_id for r in stages.orders.current().collect()) == [1, 5]
    refused = stages.rejects.current().filter("stage = 'orders'").collect()
    assert sorted(r.reason for r in refused) == ["missing review_id", "not a JSON object"]
    shops = [(40, 5, {"shop_id": 5, "shop_name": "Old"}), (41, 5, {"shop_id": 5, "shop_name": "New"}), (42, 6, {"shop_id": 6, "shop_name": ""})]
    land(spark, root, "shops", shops)
    stages.run(stream(spark, root, "shops"), stages.on_shops, "shops")
    assert [(r.shop_id, r.shop_name) for r in stages.shops.current().collect()] == [(5, "New")]


def test_early_reviews_come_in_with_their_product(spark, stages):
    root = stages.root
    land(spark, root, "reviews", [(20, 1, review(1, 7)), (21, 2, review(2, 1))])
    stages.run(stream(spark, root, "reviews"), stages.on_reviews, "reviews")
    assert [r.review_id for r in stages.reviews.current().collect()] == [2]
    land(spark, root, "products", [(30, 7, product(7))])
    stages.run(stream(spark, root, "products"), stages.on_products, "products")
    stages.on_reviews(stages.topics["review-detail"].current(), 1)
    assert sorted(r.review_id for r in stages.reviews.current().collect()) == [1, 2]
    assert sorted(r.review_id for r in stages.orders.current().collect()) == [1, 2]
    # a later message of the product sends nothing again
    land(spark, root, "products", [(31, 7, product(7, name="more"))])
    stages.run(stream(spark, root, "products"), stages.on_products, "products")
    assert stages.topics["review-detail"].current().count() == 1


@pytest.mark.parametrize("days, again, lost", [(1, [1], []), (0, [], [1])])
def test_reviews_wait_only_so_long(spark, stages, days, again, lost):
    stages.patience, root = days, stages.root
    land(spark, root, "reviews", [(20, 1, review(1, 7))])
    stages.run(stream(spark, root, "reviews"), stages.on_reviews, "reviews")
    land(spark, root, "products", [(30, 7, product(7))])
    for _ in range(2):  # a replay refuses and sends the same
        stages.on_products(stream_rows(spark, root, "products").filter("seq.at = 30"), 1)
    assert [int(r.key) for r in stages.topics["review-detail"].current().collect()] == again
    late = stages.rejects.current().filter("reason = 'waited too long'").collect()
    assert [json.loads(r.value)["id"] for r in late] == lost and {r.stage for r in late} <= {"reviews"}


def test_pages_with_neighbouring_numbers_do_not_tie(spark, stages):
    """The third element of one page and the first of the next are the same review: the page that came first wins."""
    pages = [(40, 1, {"data": [review(8, None), review(9, None), review(5, None, content="first")]}), (41, 1, {"data": [review(5, None, content="again")]})]
    land(spark, stages.root, "pages", [(i, k, {**p, "paging": {"last_page": 1}}) for i, k, p in pages])
    stages.run(stream(spark, stages.root, "pages"), stages.on_review_pages, "pages")
    stages.on_reviews(stages.topics["review-detail"].current(), 0)
    assert {r.review_id: r.comment for r in stages.reviews.current().collect()}[5] == "first"


def test_a_look_up_reads_the_folders_of_its_keys(spark, stages):
    few = spark.createDataFrame([(1,)], "product_id bigint")
    plan = stages.products.log(few)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan and "part#" in plan.split("PartitionFilters: ")[1][:60]
    assert [r.product_id for r in stages.products.log(few).collect()] == [1]


def test_finished_batches_become_runs(spark, tmp_path):
    table = LogTable(spark, str(tmp_path / "t"), "k BIGINT, v BIGINT", lambda log: log.groupBy("k").agg(F.max("v").alias("v")),
                     lambda log: log.groupBy("k").agg(F.max("v").alias("v")), "k").create()
    last = MERGE * MERGE + 2
    for batch in range(last):
        table.settle("s", batch)
        if batch in (MERGE, MERGE * MERGE):
            table.settle("s", batch)  # as after a crash
        table.append(spark.createDataFrame([(1, batch), (100 + batch, batch)], "k bigint, v bigint"), "s", batch)
    folders = sorted(p.name for p in (tmp_path / "t").glob("source=s*/batch_id=*"))
    assert folders == ["batch_id=0", f"batch_id={MERGE * MERGE}", f"batch_id={MERGE * MERGE + 1}"]
    rows = {r.k: r.v for r in table.current().collect()}
    assert rows == {1: last - 1, **{100 + b: b for b in range(last)}}
    assert table.log(before=("s", last - 1)).where("k = 1").agg(F.max("v")).first()[0] == last - 2

