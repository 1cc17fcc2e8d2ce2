"""Registered queries: price history over time and the streaming stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martlens import schemas
from martlens.operators import derive as D, prices as P, sentiment as M
from martlens.plans import sample_messages as S
from martlens.plans.ingest import REVIEW_DETAIL_SQL
from martlens.plans.oracle import PRICE_NOW, dbl, ts
from martlens.plans.registry import query
from martlens.plans.sample_model import TABLES, SampleModel, n_rows
from martlens.session import work_dir
from martlens.sources import messages, partitions
from martlens.sources.tables import LogTable
from martlens.streaming import rollups
from martlens.streaming.stages import Stages

ROLLUP_COLUMNS = f"""
round(CAST(sum(price) AS DOUBLE) / count(*), 4) AS avg_price, {dbl('min(price)', 'min_price')},
{dbl('max(price)', 'max_price')}, count(*) AS price_changes"""

# the stored rollup was made before all prices rose by one; a refresh takes the rise in, but only within its range
REFRESH_SQL = f"""
WITH span AS (SELECT date_trunc('hour', {PRICE_NOW} - INTERVAL 60 DAY) AS low, date_trunc('hour', {PRICE_NOW} - INTERVAL 24 HOUR) AS high),
seen AS (SELECT product_id, ts, price - CASE WHEN ts >= low AND ts < high THEN 0 ELSE 1 END AS price FROM m_prices, span)
SELECT product_id, {ts("date_trunc('hour', ts)", 'bucket')}, {ROLLUP_COLUMNS}
FROM seen GROUP BY product_id, date_trunc('hour', ts)"""


def _before_the_rise(m: SampleModel) -> DataFrame:
    return m.product_prices.withColumn("price", (F.col("price") - 1).cast("decimal(12,2)"))


@query("T2 T3 A9", REFRESH_SQL)
def rollup_refresh(m: SampleModel):
    stored = P.hourly_rollup(_before_the_rise(m))
    return P.refresh_rollup(stored, m.product_prices, m.price_time, start_days=60, end_hours=24)


@query("T2 T3", REFRESH_SQL)
def stored_rollup_refresh(m: SampleModel):
    """The same on disk: only the partitions in the range are rewritten (months, for this span)."""
    path = work_dir(m.spark, "rollup") + "/hourly"
    rollups.write_rollup(P.hourly_rollup(_before_the_rise(m)), path, "month")
    rollups.refresh_stored(m.product_prices, path, m.price_time, "month", start_days=60, end_hours=24)
    return m.spark.read.parquet(path).drop("bucket_period")


# prices were stored one too low; a correction of one old year, and the withdrawal of one of its months, come much later
def _corrected_sql(unit: str) -> str:
    return f"""
WITH seen AS (SELECT product_id, ts, price - CASE WHEN year(ts) = 1997 THEN 0 ELSE 1 END AS price FROM m_prices WHERE NOT (year(ts) = 1997 AND month(ts) = 3))
SELECT product_id, {ts(f"date_trunc('{unit}', ts)", 'bucket')}, {ROLLUP_COLUMNS} FROM seen GROUP BY product_id, date_trunc('{unit}', ts)"""


def _corrected_rollup(m: SampleModel) -> rollups.StoredRollup:
    kept = rollups.StoredRollup(m.spark, work_dir(m.spark, "states"), "month")
    kept.add(_before_the_rise(m), 0)
    kept.refresh(-1, 0)
    year, month = F.year("timestamp"), F.month("timestamp")
    right = m.product_prices.where(year == 1997).withColumn("price", F.when(month != 3, F.col("price")))
    kept.add(right, 1)
    kept.refresh(0, 1)
    return kept


@query("T1 T2 T3 A9", _corrected_sql("hour"))
def corrected_hourly_rollup(m: SampleModel):
    return _corrected_rollup(m).rollup()


@query("T1 T2 F2", _corrected_sql("week"))
def corrected_weekly_rollup(m: SampleModel):
    """Weeks added up from the stored hours."""
    return _corrected_rollup(m).rollup("week")


@query(
    "T4",
    f"""
SELECT product_id, {dbl('price')}, {ts('ts', '"timestamp"')} FROM m_prices WHERE ts >= {PRICE_NOW} - INTERVAL 90 DAY""",
)
def retained_prices(m: SampleModel):
    return P.retained(m.product_prices.select("product_id", "price", "timestamp"), m.price_time)


@query(
    "T4",
    f"""
SELECT product_id, {dbl('price')}, {ts('ts', '"timestamp"')} FROM m_prices
WHERE date_trunc('month', ts) >= date_trunc('month', {PRICE_NOW} - INTERVAL 90 DAY)""",
)
def stored_retention(m: SampleModel):
    """Whole months older than the retained days leave the disk."""
    path = work_dir(m.spark, "history") + "/prices"
    rollups.write_history(m.product_prices.select("product_id", "price", "timestamp"), path, "month")
    rollups.drop_expired(m.spark, path, m.price_time, 90, "month")
    return m.spark.read.parquet(path).drop("price_period")


@query(
    "T10",
    f"""
WITH known AS (SELECT product_id, date_trunc('month', ts) AS d, arg_max(price, ts) AS price FROM m_prices GROUP BY 1, 2),
span AS (SELECT product_id, min(d) AS lo, max(d) AS hi FROM known GROUP BY 1),
months AS (SELECT product_id, unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS d FROM span)
SELECT months.product_id, {ts('months.d', 'period')}, CAST(last_value(price IGNORE NULLS) OVER (PARTITION BY months.product_id ORDER BY months.d) AS DOUBLE) AS price,
       price IS NULL AS filled
FROM months LEFT JOIN known k ON k.product_id = months.product_id AND k.d = months.d""",
)
def filled_price_series(m: SampleModel):
    return P.filled_series(m.product_prices, "month")


@query(
    "T10",
    f"""
SELECT product_id, {ts('ts', '"timestamp"')}, {dbl('price')}, discount_percent FROM m_prices""",
)
def price_history(m: SampleModel):
    return P.product_history(m.product_prices)


@query(
    "T9",
    """
SELECT strftime(date_trunc('hour', created_at), '%Y-%m-%d %H:%M:%S.%f') AS window_start, count(*) AS messages,
       round(count(*) / 3600.0, 6) AS per_second FROM m_facts GROUP BY 1""",
)
def message_throughput(m: SampleModel):
    return rollups.throughput(m.review_facts, "created_at")


# streams -----------------------------------------------------------------------------------


def _event_stream(m: SampleModel) -> DataFrame:
    """The events file as a stream of price rows."""
    reader = m.spark.readStream.schema(TABLES["events"]).option("pathGlobFilter", "events.parquet")
    stream = reader.parquet(m.folder)
    return stream.select(
        "event_id",
        (F.col("event_id") % 5).alias("product_id"),
        F.col("value").cast("decimal(12,2)").alias("price"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


@query(
    "T1 T3 S1",
    f"""
SELECT event_id % 5 AS product_id, {ts("date_trunc('hour', ts)", 'bucket')}, {ROLLUP_COLUMNS.replace('(price)', '(CAST(value AS DECIMAL(12,2)))')}
FROM events WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 3 DAY
GROUP BY event_id % 5, date_trunc('hour', ts)""",
)
def streamed_hourly_rollup(m: SampleModel):
    root = work_dir(m.spark, "stream-rollup")
    rolled = rollups.hourly_rollup_stream(_event_stream(m))
    rollups.write_available(rolled, f"{root}/out", f"{root}/checkpoint")
    return m.spark.read.parquet(f"{root}/out")


@query("S2 S3", "SELECT event_type AS topic, CAST(event_id AS VARCHAR) AS key, user_id FROM events")
def streamed_keyed_messages(m: SampleModel):
    """Events sent as keyed messages, a second run of the stream sending nothing twice."""
    root = work_dir(m.spark, "stream-topics")
    raw = m.spark.readStream.schema(TABLES["events"]).option("pathGlobFilter", "events.parquet").parquet(m.folder)
    body = F.to_json(F.struct("event_id", "user_id"))
    sent = raw.select(F.col("event_type").alias("topic"), F.col("event_id").cast("string").alias("key"), body.alias("value"))
    for _ in range(2):
        messages.stream_topics(sent, f"{root}/out", f"{root}/checkpoint")
    read = m.spark.read.schema("topic STRING, key STRING, value STRING").json(f"{root}/out")
    return read.select("topic", "key", F.get_json_object("value", "$.user_id").cast("bigint").alias("user_id"))


@query("T5 U6", "SELECT event_id, event_id % 5 AS product_id FROM events")
def streamed_first_messages(m: SampleModel):
    root = work_dir(m.spark, "stream-first")
    # every message arrives twice
    doubled = _event_stream(m).withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    first = rollups.first_seen_stream(doubled, "event_id", "timestamp").select("event_id", "product_id")
    rollups.write_available(first, f"{root}/out", f"{root}/checkpoint")
    return m.spark.read.parquet(f"{root}/out")


@query("T5 U6", "SELECT event_id, event_id % 5 AS product_id FROM events")
def streamed_first_of_all_history(m: SampleModel):
    """Every message comes again in a later batch, a month after the watermark has passed; the stored key drops it."""
    root = work_dir(m.spark, "stream-ever")
    stored = LogTable(m.spark, f"{root}/out", "event_id BIGINT, product_id BIGINT, timestamp TIMESTAMP", key="event_id").create()
    for days in (0, 30):
        rows = m.raw("events").select("event_id", (F.col("event_id") % 5).alias("product_id"), F.timestamp_add("DAY", F.lit(days), F.col("ts")).alias("timestamp"))
        rows.write.mode("append").parquet(f"{root}/in")
        stream = m.spark.readStream.schema(rows.schema).parquet(f"{root}/in")
        rollups.store_first(stream, stored, "events", "timestamp", f"{root}/checkpoint")
    return stored.current().select("event_id", "product_id")


@query("S1", "SELECT CAST(user_id AS VARCHAR) AS key, max(event_id) AS last_event FROM events GROUP BY 1")
def streamed_message_order(m: SampleModel):
    """The last message of each key, all of one moment, told apart by offsets that pass multiples of a million."""
    root = work_dir(m.spark, "stream-order")
    k = F.col("event_id")
    at = F.lit("2024-01-01").cast("timestamp").alias("timestamp")
    offset = (k + 1_000_000 - n_rows(m.raw("events")) / 2).cast("bigint").alias("offset")
    sent = m.raw("events").select(at, F.lit(0).alias("partition"), offset, F.col("user_id").cast("string").alias("key"), k.cast("string").alias("value"))
    sent.write.json(f"{root}/in")
    rollups.write_available(messages.read_stream(m.spark, "json", {}, f"{root}/in"), f"{root}/out", f"{root}/checkpoint")
    last = F.max_by("value", "seq").cast("bigint").alias("last_event")
    return m.spark.read.parquet(f"{root}/out").groupBy("key").agg(last)


@query("S1 T6", "SELECT user_id % 4 AS part, count(*) AS messages, max(event_id) AS last_event, min(event_id) AS first_event FROM events GROUP BY 1")
def streamed_partitions(m: SampleModel):
    """Four landed partitions by offset: the earlier half, then the rest while the earlier half is landed a second time."""
    root = work_dir(m.spark, "stream-partitions")
    k, middle = F.col("event_id"), n_rows(m.raw("events")) / 2
    part, offset = (F.col("user_id") % 4).cast("int"), k + 999_000
    sent = m.raw("events").select(part.alias("partition"), offset.alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"),
                                  F.col("user_id").cast("string").alias("key"), k.cast("string").alias("value"))
    early = sent.filter(F.col("value").cast("bigint") < middle)
    for rows in (early, sent):
        partitions.land(rows, f"{root}/in")
        rollups.write_available(messages.read_stream(m.spark, "partitions", {}, f"{root}/in"), f"{root}/out", f"{root}/checkpoint")
    read, event = m.spark.read.parquet(f"{root}/out"), F.col("value").cast("bigint")
    by_place = [f("value", F.struct("seq.offset")).cast("bigint").alias(n) for f, n in ((F.max_by, "last_event"), (F.min_by, "first_event"))]
    return read.groupBy(F.col("seq.part").cast("bigint").alias("part")).agg(F.count(event).alias("messages"), *by_place)


def _land(df: DataFrame, path: str) -> None:
    df.select("seq", "key", "value").write.mode("overwrite").json(path)


def _stages(m: SampleModel, replay: bool = False) -> Stages:
    """Products, then reviews, through the stages; a replay feeds the reviews a second time."""
    root = work_dir(m.spark, "stages")
    stages = Stages(m.spark, root, scorer=M.score_with_lexicon).create()
    # every product is sent under twice its number, so that reviews of odd numbers have no product
    sent = SampleModel(m.spark, m.folder)
    sent.parts = m.parts.withColumn("p_partkey", F.col("p_partkey") * 2)
    _land(S.product_messages(sent, versions=1), f"{root}/in/products")
    _land(S.review_messages(m), f"{root}/in/reviews")
    stream = lambda name: messages.read_stream(m.spark, "json", {}, f"{root}/in/{name}")
    stages.run(stream("products"), stages.on_products, "products")
    stages.run(stream("reviews"), stages.on_reviews, "reviews")
    if replay:
        stages.seen = stages.orders.current().select(F.max("created_at")).first()[0]
        # a lost checkpoint: the same batch comes again under the same number
        stages.run(stream("reviews"), stages.on_reviews, "reviews-again")
    return stages


# product messages of version 1 under the even numbers
STAGED_PRODUCTS = """
SELECT p_partkey AS product_id, CASE WHEN (p_partkey + 1) % 7 = 0 THEN 0 WHEN (p_partkey + 1) % 6 <> 0 THEN p_partkey % 100 + 10 END AS price
FROM (SELECT p_partkey * 2 AS p_partkey FROM part)"""
STAGED_REVIEWS = f"""
SELECT r.* FROM ({REVIEW_DETAIL_SQL}) r JOIN ({STAGED_PRODUCTS}) p ON r.product_id = p.product_id
WHERE seq % 2 = 0 AND review_id <> 0 AND r.product_id <> 0"""


# times that a message does not have are those of its batch, which SQL cannot know
OWN_TIME = "strftime(CASE WHEN review_id % 7 <> 0 THEN created_at END, '%Y-%m-%d %H:%M:%S.%f')"


@query(
    "T7 U6",
    f"SELECT review_id, product_id, user_name, rating, comment, has_images, helpful_count, {OWN_TIME} AS created_at FROM ({STAGED_REVIEWS})",
)
def staged_reviews(m: SampleModel):
    rows = _stages(m).reviews.current()
    return rows.withColumn("created_at", F.nullif("created_at", "crawled_at")).drop("crawled_at")


@query("T7", f"SELECT review_id, product_id, comment FROM ({STAGED_REVIEWS})")
def staged_early_reviews(m: SampleModel):
    """All reviews come a batch before their products, wait, and are sent again when these come."""
    stages = Stages(m.spark, work_dir(m.spark, "early")).create()
    sent = SampleModel(m.spark, m.folder)
    sent.parts = m.parts.withColumn("p_partkey", F.col("p_partkey") * 2)
    for name, rows, stage in (("reviews", S.review_messages(m), stages.on_reviews), ("products", S.product_messages(sent, versions=1), stages.on_products)):
        _land(rows, f"{stages.root}/in/{name}")
        stages.run(messages.read_stream(m.spark, "json", {}, f"{stages.root}/in/{name}"), stage, name)
    stages.on_reviews(stages.topics["review-detail"].current(), 1)
    return stages.reviews.current().select("review_id", "product_id", "comment")


@query(
    "T6 T7 T8 D1 U7",
    f"""
SELECT review_id AS order_id, customer_id, review_id, CAST(nullif(price, 0) AS DOUBLE) AS total_amount, 'completed' AS status,
       {OWN_TIME} AS order_date, true AS first_time
FROM ({STAGED_REVIEWS}) JOIN ({STAGED_PRODUCTS}) USING (product_id) WHERE customer_id <> 0""",
)
def staged_orders_after_replay(m: SampleModel):
    """`first_time`: the replay wrote the time at which the batch was first seen."""
    stages = _stages(m, replay=True)
    rows = stages.orders.current().withColumn("order_date", F.nullif("order_date", "created_at"))
    return rows.withColumn("first_time", F.col("created_at") == F.lit(stages.seen)).drop("created_at")


@query(
    "T8 D5 S2",
    f"SELECT CAST(review_id AS VARCHAR) AS key, comment FROM ({STAGED_REVIEWS})",
)
def staged_sentiment_requests(m: SampleModel):
    sent = _stages(m).topics["sentiment-analysis"].current()
    body = F.from_json("value", schemas.SENTIMENT_MESSAGE)
    return sent.select("key", body.getField("comment").alias("comment"))


@query(
    "T9 Q6",
    f"""
SELECT 'products' AS stage, (SELECT count(*) FROM ({STAGED_PRODUCTS})) AS processed, 0 AS failed
UNION ALL SELECT 'reviews', (SELECT count(*) FROM ({REVIEW_DETAIL_SQL}) r WHERE review_id <> 0 AND product_id <> 0 AND product_id IN (SELECT product_id FROM ({STAGED_PRODUCTS}))),
  (SELECT count(*) FROM ({REVIEW_DETAIL_SQL}) r WHERE review_id = 0 OR product_id = 0 OR product_id NOT IN (SELECT product_id FROM ({STAGED_PRODUCTS})))""",
)
def stage_metrics(m: SampleModel):
    return _stages(m).metrics.current()


# product pages as they land: every third is cut off, every seventh has no list, every eleventh a bad key
_PAGE_KIND = """CASE WHEN k % 3 = 0 THEN 'not a JSON object' WHEN k % 11 = 0 THEN 'key is not a product id'
  WHEN k % 7 = 0 THEN 'no list of reviews' END"""


def _page_stage(m: SampleModel) -> Stages:
    """Landed review pages, some of which cannot be read, through their stage."""
    stages = Stages(m.spark, work_dir(m.spark, "pages")).create()
    k = F.col("p_partkey")
    reviews = ",".join(f'{{"id": %d{i}, "rating": 5, "content": "good", "created_by": {{"id": %d, "name": "N"}}}}' for i in (1, 2))
    data = F.when(k % 7 == 0, "null").otherwise(F.format_string(f"[{reviews}]", k, k, k, k))
    body = F.concat(F.lit('{"data": '), data, F.lit(', "paging": {"last_page": 1}}'))
    cut = F.when(k % 3 == 0, F.substring(body, 1, 12)).otherwise(body)
    key = F.when(k % 11 == 0, "abc").otherwise(k.cast("string"))
    _land(m.raw("part").select(k.alias("seq"), key.alias("key"), cut.alias("value")), f"{stages.root}/in/pages")
    stages.run(messages.read_stream(m.spark, "json", {}, f"{stages.root}/in/pages"), stages.on_review_pages, "pages")
    return stages


@query(
    "T7 P1",
    f"""
WITH pages AS (SELECT k, {_PAGE_KIND} AS reason FROM (SELECT p_partkey AS k FROM part))
SELECT 'sent' AS outcome, k AS product_id, CAST(k || i AS VARCHAR) AS key FROM pages, (VALUES ('1'), ('2')) v(i) WHERE reason IS NULL
UNION ALL SELECT reason, CASE WHEN reason <> 'not a JSON object' THEN k END, NULL FROM pages WHERE reason IS NOT NULL""",
)
def staged_review_pages(m: SampleModel):
    """Review messages sent on, and refused pages with what can be read from their kept body."""
    stages = _page_stage(m)
    product = F.get_json_object("value", "$.product_id").cast("bigint")
    sent = stages.topics["review-detail"].current().select(F.lit("sent").alias("outcome"), product.alias("product_id"), "key")
    lost = stages.rejects.current()
    readable = F.col("reason") != "not a JSON object"
    return sent.unionByName(
        lost.select(F.col("reason").alias("outcome"), F.when(readable, F.col("seq.at")).alias("product_id"), F.lit(None).cast("string").alias("key"))
    )


@query(
    "T9",
    f"""
WITH pages AS (SELECT {_PAGE_KIND} AS reason FROM (SELECT p_partkey AS k FROM part))
SELECT 'review_pages' AS stage, count(*) FILTER (reason IS NULL) AS processed, count(reason) AS failed FROM pages""",
)
def review_page_metrics(m: SampleModel):
    return _page_stage(m).metrics.current()


@query(
    "T7 T8 D5 U7 U8",
    f"""
WITH kinds AS (SELECT k, {_PAGE_KIND} AS reason FROM (SELECT p_partkey AS k FROM part)),
priced AS (SELECT p_partkey AS product_id, CASE WHEN (p_partkey + 1) % 7 = 0 THEN 0 WHEN (p_partkey + 1) % 6 <> 0 THEN p_partkey % 100 + 10 END AS price FROM part)
SELECT k * 10 + i AS review_id, k AS product_id, CASE WHEN k <> 0 THEN k * 10 + i END AS order_id,
       CASE WHEN k <> 0 THEN CAST(nullif(price, 0) AS DOUBLE) END AS total_amount, 'positive' AS sentiment
FROM kinds JOIN priced ON product_id = k, (VALUES (1), (2)) v(i) WHERE reason IS NULL AND k <> 0""",
)
def staged_chain(m: SampleModel):
    """Products and review pages through every stage; the order, sentiment and backfill stages add nothing twice."""
    stages = _page_stage(m)
    _land(S.product_messages(m, versions=1), f"{stages.root}/in/products")
    stages.run(messages.read_stream(m.spark, "json", {}, f"{stages.root}/in/products"), stages.on_products, "products")
    sent = lambda topic: stages.topics[topic].current()
    stages.on_reviews(sent("review-detail"), 0)
    stages.on_orders(sent("orders"), 0)
    stages.on_sentiment(sent("sentiment-analysis"), 0)
    # a backfill queues nothing that is scored already
    queue = D.backfill_sentiment_queue(stages.reviews.current(), stages.sentiment.current().select("review_id"))
    body = F.to_json(F.struct("review_id", "comment"))
    stages.on_sentiment(queue.select(messages.place(F.lit(1)).alias("seq"), F.lit(None).cast("string").alias("key"), body.alias("value")), 1)
    orders = stages.orders.current().select("review_id", "order_id", "total_amount")
    scores = stages.sentiment.current().select("review_id", "sentiment")
    return stages.reviews.current().select("review_id", "product_id").join(orders, "review_id", "left").join(scores, "review_id", "left")
