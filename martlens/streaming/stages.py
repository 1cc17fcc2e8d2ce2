"""The message stages: products, product details, review pages, reviews, orders, sentiment and shops.

Each stage handles one micro-batch with joins instead of lookups and writes everything the
batch causes under the batch's own id, so a replay after a crash rewrites the same rows.
Rows a stage refuses go to the rejects table with a reason and their whole body, so they can be replayed.  Of reviews that
repeat, over whatever time, the first stored one wins: a batch looks its keys up in the folders they fall into.
Those folders grow with the tables, but a batch of few keys reads few of them, and finished batches are merged
as they become many.  Reviews that come before their product wait and are sent again with its first message, unless
that comes more than `patience` days later; then they are refused for good.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from martlens import schemas
from martlens.functions import scalars as X
from martlens.operators import derive, merge, parse, quality, sentiment
from martlens.sources import messages
from martlens.sources.tables import LogTable

# `seq` places messages across all streams; see messages.place.
MESSAGE = f"seq {messages.PLACE}, key STRING, value STRING"
Scorer = Callable[[DataFrame], DataFrame]

# Place of a row among all of its key.
ORDER_AT = f"order_at STRUCT<seq: {messages.PLACE}, stage: INT, batch: BIGINT>"
# Update logs hold what messages set; `present` lists the columns each row sets.
UPDATES = (
    "product_id BIGINT, name STRING, url STRING, image_url STRING, description STRING, "
    "shop_id BIGINT, category_id INT, rating DECIMAL(3,2), sold_count INT, review_count INT, "
    "discount_rate INT, short_description STRING, authors STRING, specifications STRING, "
    f"configurable_options STRING, present ARRAY<STRING>, {ORDER_AT}"
)
SELLERS = f"shop_id BIGINT, shop_name STRING, {ORDER_AT}"
CUSTOMERS = f"customer_id BIGINT, customer_name STRING, {ORDER_AT}"
PRICES = f"{schemas.TABLES['product_prices']}, {ORDER_AT}"
REVIEWS = f"{schemas.TABLES['reviews']}, {ORDER_AT}"
ORDERS = f"{schemas.TABLES['orders']}, {ORDER_AT}"
ORDER_LINES = f"{schemas.TABLES['order_lines']}, {ORDER_AT}"
SENTIMENTS = f"{schemas.TABLES['review_sentiment']}, {ORDER_AT}"
LISTED = ("name", "url", "image_url", "description", "shop_id", "category_id", "rating", "sold_count")
REJECTS = f"stage STRING, seq {messages.PLACE}, value STRING, reason STRING"
WAITING = f"product_id BIGINT, {MESSAGE}, since TIMESTAMP"
METRICS = "stage STRING, processed BIGINT, failed BIGINT"


def _order(stage: int, batch_id: int) -> Column:
    """Place of an update among all of its key: by the message's place, which all streams share."""
    return F.struct(
        F.col("seq"), F.lit(stage).alias("stage"), F.lit(batch_id).cast("bigint").alias("batch")
    )


def _place(batch_id: int) -> Column:
    """Place of a row in a table that gets one row per key and batch."""
    batch = F.lit(batch_id).cast("bigint")
    return F.struct(messages.place(batch).alias("seq"), F.lit(0).alias("stage"), batch.alias("batch"))


def _unreadable(body: str) -> Column:
    """Whether a message is anything but a JSON object."""
    return F.json_object_keys(body).isNull()


def _shorten_products(log: DataFrame) -> DataFrame:
    """One update per product that sets the last value of every column that was ever set."""
    columns = [c for c in log.columns if c not in ("product_id", "present", "order_at")]
    last = log.groupBy("product_id").agg(F.max("order_at").alias("order_at"))
    folded = merge.fold_updates(log, "product_id", columns, "present", "order_at").join(last, "product_id")
    sets = F.array_compact(F.array(*[F.when(F.col(f"_set_{c}"), F.lit(c)) for c in columns]))
    return folded.withColumn("present", sets).select(*log.columns)


def _fold_products(log: DataFrame) -> DataFrame:
    columns = [c for c in log.columns if c not in ("product_id", "present", "order_at")]
    folded = merge.fold_updates(log, "product_id", columns, "present", "order_at")
    sold = F.when(F.col("_set_sold_count"), F.col("sold_count")).otherwise(0)
    return folded.withColumn("sold_count", sold).select("product_id", *columns)


def _shorten_shops(log: DataFrame) -> DataFrame:
    named = F.when(X.is_truthy("shop_name", log.schema["shop_name"].dataType), F.col("order_at"))
    name = F.max_by("shop_name", named).alias("shop_name")
    return log.groupBy("shop_id").agg(name, F.max("order_at").alias("order_at"))


def _fold_shops(log: DataFrame) -> DataFrame:
    placeholder = F.concat(F.lit("Shop "), F.col("shop_id"))
    return _shorten_shops(log).select("shop_id", F.coalesce("shop_name", placeholder).alias("shop_name"))


def _shorten_customers(log: DataFrame) -> DataFrame:
    name = F.max_by("customer_name", "order_at").alias("customer_name")
    return log.groupBy("customer_id").agg(name, F.max("order_at").alias("order_at"))


def _fold_customers(log: DataFrame) -> DataFrame:
    return _shorten_customers(log).drop("order_at")


def _shorten_prices(log: DataFrame) -> DataFrame:
    """The price recorded first for each product and time."""
    values = [F.min_by(c, "order_at").alias(c) for c in merge.PRICE_VALUES]
    return log.groupBy("product_id", "timestamp").agg(*values, F.min("order_at").alias("order_at"))


def _fold_prices(log: DataFrame) -> DataFrame:
    return _shorten_prices(log).drop("order_at")


def _shorten_once(key: str) -> Callable[[DataFrame], DataFrame]:
    """First wins: the earliest row of each key, with its place in the order."""
    return lambda log: merge.first_wins(log, key, "order_at")


def _fold_once(key: str) -> Callable[[DataFrame], DataFrame]:
    return lambda log: merge.first_wins(log, key, "order_at").drop("order_at")


class Stages:
    """Tables under one shared folder and the stages that feed them."""

    def __init__(self, spark: SparkSession, root: str, scorer: Scorer = sentiment.score_with_lexicon, patience: int | None = None):
        self.spark, self.root, self.scorer, self.patience = spark, root, scorer, patience
        table = lambda name, *how: LogTable(spark, f"{root}/tables/{name}", *how)
        once = lambda name, columns, key: table(name, columns, _fold_once(key), _shorten_once(key), key)
        self.products = table("products", UPDATES, _fold_products, _shorten_products, "product_id")
        self.shops = table("shops", SELLERS, _fold_shops, _shorten_shops, "shop_id")
        self.categories = table("categories", "category_id INT", DataFrame.distinct, DataFrame.distinct)
        self.prices = table("product_prices", PRICES, _fold_prices, _shorten_prices, "product_id")
        self.reviews = once("reviews", REVIEWS, "review_id")
        self.orders = once("orders", ORDERS, "review_id")
        self.order_lines = once("order_lines", ORDER_LINES, "order_id")
        self.customers = table("customers", CUSTOMERS, _fold_customers, _shorten_customers, "customer_id")
        self.waiting = table("waiting", WAITING, DataFrame.distinct, DataFrame.distinct, "product_id")
        self.sentiment = once("review_sentiment", SENTIMENTS, "review_id")
        self.rejects = table("rejects", REJECTS)
        self.metrics = table("metrics", METRICS)
        self.topics = {t: table(f"topic_{t.replace('-', '_')}", MESSAGE) for t in schemas.STAGE_TOPICS}
        self.tables = (
            self.products,
            self.shops,
            self.categories,
            self.prices,
            self.reviews,
            self.orders,
            self.order_lines,
            self.customers,
            self.waiting,
            self.sentiment,
            self.rejects,
            self.metrics,
            *self.topics.values(),
        )

    def create(self) -> Stages:
        for t in self.tables:
            t.create()
        return self

    def _finish(self, stage: str, batch_id: int, judged: DataFrame) -> None:
        """Write refused rows, and the counts observed in passing; `judged` has seq, value and a reason or null."""
        refused, seen = F.col("reason").isNotNull(), Observation(f"{stage} {batch_id}")
        counted = judged.observe(seen, F.count_if(~refused).alias("processed"), F.count_if(refused).alias("failed"))
        rejects = counted.filter(refused).select(F.lit(stage).alias("stage"), "seq", "value", "reason")
        self.rejects.append(rejects, stage, batch_id)
        counts = (stage, seen.get.get("processed", 0), seen.get.get("failed", 0))
        self.metrics.append(self.spark.createDataFrame([counts], METRICS), stage, batch_id)

    def _settle(self, stage: str, batch_id: int) -> None:
        """Merge what earlier batches of this stage left, before a new one adds to it."""
        for table in self.tables:
            table.settle(stage, batch_id)

    def _time(self, stage: str, batch_id: int) -> Column:
        """When a batch was first seen; a replay gets the same time, hence the same rows."""
        path = f"{self.root}/times/{stage}/{batch_id}"
        try:
            seen = self.spark.read.schema("at TIMESTAMP").parquet(path).first()
        except AnalysisException:  # no such folder: the first time
            seen = None
        if seen is None:
            seen = self.spark.range(1).select(F.current_timestamp().alias("at")).first()
            self.spark.createDataFrame([seen], "at TIMESTAMP").coalesce(1).write.mode("overwrite").parquet(path)
        return F.lit(seen["at"])

    def _send(self, topic: str, rows: DataFrame, key: str, stage: str, batch_id: int) -> None:
        """Append JSON messages to a topic, each in the place of the message that caused it."""
        body = F.to_json(F.struct(*[c for c in rows.columns if c != "seq"]), {"ignoreNullFields": "false"})
        out = rows.select("seq", F.col(key).cast("string").alias("key"), body.alias("value"))
        self.topics[topic].append(out, stage, batch_id)

    # stages ----------------------------------------------------------------------------------

    def on_products(self, batch: DataFrame, batch_id: int) -> None:
        """Flat product items: products, prices, placeholder shops and categories, detail requests."""
        stage = "products"
        self._settle(stage, batch_id)
        read = messages.json_messages(batch.withColumn("body", F.col("value")), schemas.PRODUCT_MESSAGE)
        checked = quality.with_violations(read, quality.PRODUCT)
        broken = F.when(F.size("violations") > 0, F.array_join("violations", ","))
        reason = F.when(F.col("corrupt").isNotNull(), "not a JSON object").otherwise(broken)
        judged = (
            checked.withColumn("reason", reason)
            .withColumnRenamed("body", "value")
            .drop("violations", "corrupt")
            .persist()
        )
        ok = judged.filter("reason IS NULL")
        now = self._time(stage, batch_id)
        at = X.moment("kafka_timestamp", X.moment("crawled_at", now))
        sets = F.array_intersect("present", F.array(*[F.lit(c) for c in LISTED]))
        listed = ok.withColumns({"present": sets, "rating": F.col("rating").try_cast("decimal(3,2)")})
        blank = {f.name: F.lit(None).cast(f.dataType) for f in self.products.schema if f.name not in listed.columns}
        blank["order_at"] = _order(0, batch_id)
        self.products.append(listed.withColumns(blank), stage, batch_id)
        is_set = lambda c: F.coalesce(F.col(c), F.lit(0)) != 0
        unnamed = F.lit(None).cast("string").alias("shop_name")
        shops = ok.filter(is_set("shop_id")).select("shop_id", unnamed, _order(0, batch_id).alias("order_at"))
        self.shops.append(shops, stage, batch_id)
        self.categories.append(ok.filter(is_set("category_id")).select("category_id").distinct(), stage, batch_id)
        priced = merge.price_rows(ok.withColumn("timestamp", at))
        self.prices.append(priced.withColumn("order_at", _order(0, batch_id)), stage, batch_id)
        self._send("product-detail", parse.detail_requests(ok, ("seq",)), "product_id", stage, batch_id)
        # reviews that came before their product are sent again with its first message
        known = self.products.log(ok, before=(stage, batch_id)).select("product_id")
        first = ok.select("product_id").distinct().join(known, "product_id", "left_anti").persist()
        waited = self.waiting.current(first)
        if self.patience is not None:
            late = F.col("since") < F.timestamp_add("DAY", F.lit(-self.patience), now)
            lost = waited.filter(late).select(F.lit("reviews").alias("stage"), "seq", "value", F.lit("waited too long").alias("reason"))
            self.rejects.append(lost, f"{stage}-late", batch_id)
            waited = waited.filter(~late)
        self.topics["review-detail"].append(waited.drop("product_id", "since"), stage, batch_id)
        self._finish(stage, batch_id, judged)
        first.unpersist()
        judged.unpersist()

    def on_details(self, batch: DataFrame, batch_id: int) -> None:
        """Landed detail payloads: enrich products, name shops, ask for reviews."""
        stage = "details"
        self._settle(stage, batch_id)
        found = parse.product_details(batch.select("seq", F.col("value").alias("body"), "value"))
        has_id = F.coalesce(F.col("product_id"), F.lit(0)) != 0
        reason = F.when(_unreadable("body"), "not a JSON object").when(~has_id, "missing product_id")
        judged = found.withColumn("reason", reason).withColumnRenamed("body", "value").persist()
        ok = judged.filter("reason IS NULL").drop("reason", "value")
        values = [c for c in found.columns if c not in ("seq", "body", "product_id", "shop_name")]
        sets = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.lit(c)) for c in values]))
        order = _order(1, batch_id).alias("order_at")
        self.products.append(ok.select("product_id", *values, sets.alias("present"), order), stage, batch_id)
        self.shops.append(ok.filter("shop_id IS NOT NULL").select("shop_id", "shop_name", order), stage, batch_id)
        categories = ok.filter("category_id IS NOT NULL").select("category_id").distinct()
        self.categories.append(categories, stage, batch_id)
        unknown_spid = F.lit(None).cast("bigint").alias("spid")
        asked = ok.select("seq", "product_id", unknown_spid, F.col("shop_id").alias("seller_id"))
        self._send("review-fetch", parse.review_requests(asked, ("seq",)), "product_id", stage, batch_id)
        self._finish(stage, batch_id, judged)
        judged.unpersist()

    def on_review_pages(self, batch: DataFrame, batch_id: int) -> None:
        """Landed review pages (key = product id): one review message per element.

        A page is judged before it is taken apart, so one that cannot be read is refused, not lost.
        """
        stage = "review_pages"
        self._settle(stage, batch_id)
        read = messages.json_messages(batch.withColumn("body", F.col("value")), schemas.PAGE)
        product = F.col("key").try_cast("bigint")
        reason = (
            F.when(F.col("corrupt").isNotNull(), "not a JSON object")
            .when(product.isNull(), "key is not a product id")
            .when(F.col("data").isNull(), "no list of reviews")
        )
        judged = read.select("seq", "key", F.col("body").alias("value"), reason.alias("reason"), "data").persist()
        elements = judged.filter("reason IS NULL").select(
            "seq", "key", F.posexplode("data").alias("position", "element")
        )
        review = F.from_json("element", schemas.REVIEW_DETAIL)
        stamped = elements.withColumn("_r", review.withField("product_id", product))
        out = stamped.select(
            F.col("seq").withField("position", F.col("position")).alias("seq"),
            F.col("_r.id").cast("string").alias("key"),
            F.to_json("_r", {"ignoreNullFields": "false"}).alias("value"),
        )
        self.topics["review-detail"].append(out, stage, batch_id)
        self._finish(stage, batch_id, judged)
        judged.unpersist()

    def on_reviews(self, batch: DataFrame, batch_id: int) -> None:
        """Full reviews: store those of known products, then their orders and sentiment.

        Orders and sentiment come from the same batch under the same id, so a crash between the
        writes is repaired by the replay instead of losing messages.
        """
        stage = "reviews"
        self._settle(stage, batch_id)
        now = self._time(stage, batch_id)
        read = parse.review_details(batch.select("seq", F.col("value").alias("body"), "value"), now, unreadable="_unreadable")
        read = read.persist()
        known = self.products.log(read).select("product_id").distinct().withColumn("_known", F.lit(True))
        falsy = lambda c: F.coalesce(F.col(c), F.lit(0)) == 0
        reason = (
            F.when(F.col("_unreadable"), "not a JSON object")
            .when(falsy("review_id"), "missing review_id")
            .when(falsy("product_id"), "missing product_id")
            .when(F.col("_known").isNull(), "unknown product")
            .when(~F.coalesce(F.col("rating").between(1, 5), F.lit(False)), "rating out of range")
        )
        judged = (
            read.join(known, "product_id", "left")
            .withColumn("reason", reason)
            .withColumnRenamed("body", "value")
            .drop("_known", "_unreadable")
            .persist()
        )
        early = judged.filter("reason = 'unknown product'")
        body = F.col("value")
        held = early.select("product_id", "seq", F.col("review_id").cast("string").alias("key"), body, now.alias("since"))
        self.waiting.append(held, stage, batch_id)
        ok = judged.filter("reason IS NULL").drop("reason", "value")
        stored = self.reviews.log(ok, before=(stage, batch_id))
        new = merge.new_rows(ok, stored, "review_id").persist()
        write = lambda table, rows, place: table.append(rows.withColumn("order_at", place), stage, batch_id)

        write(self.reviews, new.withColumn("crawled_at", now), _order(0, batch_id))
        self._send("orders", parse.order_messages(new, ("seq",)), "review_id", stage, batch_id)
        self._send("sentiment-analysis", parse.sentiment_messages(new, ("seq",)), "review_id", stage, batch_id)
        buyers = new.withColumnRenamed("user_name", "customer_name").withColumn("order_date", F.col("created_at"))
        self._write_orders(buyers, now, stage, batch_id)
        scored = self.scorer(new.select("review_id", "comment"))
        write(self.sentiment, sentiment.sentiment_rows(scored, now), _place(batch_id))
        self._finish(stage, batch_id, judged)
        for held in (new, judged, read):
            held.unpersist()

    def _write_orders(self, buyers: DataFrame, now: Column, stage: str, batch_id: int) -> None:
        """Orders, their lines and customers of accepted reviews or order messages, which hold each review once."""
        products = self.products.log(buyers).select("product_id")
        prices = self.prices.current(buyers)
        keep = ("seq",)
        facts = derive.order_facts(buyers, products, prices, now=now, keep=keep, once=True).persist()
        rows = ((self.orders, derive.orders_of(facts, keep)), (self.order_lines, derive.order_lines_of(facts, keep)))
        for table, made in rows:
            placed = made.withColumns({"created_at": now, "order_at": _order(0, batch_id)})
            table.append(placed, stage, batch_id)
        named = buyers.filter(F.coalesce(F.col("customer_id"), F.lit(0)) != 0)
        order = _order(2, batch_id).alias("order_at")
        self.customers.append(named.select("customer_id", "customer_name", order), stage, batch_id)
        facts.unpersist()

    def _judged(self, batch: DataFrame, schema: str, reasons: Column) -> DataFrame:
        """Decoded messages with their body as `value` and why they are refused, or null."""
        read = messages.json_messages(batch.withColumn("body", F.col("value")), schema)
        reason = F.when(F.col("corrupt").isNotNull(), "not a JSON object").otherwise(reasons)
        return read.withColumn("reason", reason).withColumnRenamed("body", "value").drop("corrupt", "present").persist()

    def on_orders(self, batch: DataFrame, batch_id: int) -> None:
        """Order messages: one order per review; those the review stage has written already change nothing."""
        stage = "orders"
        self._settle(stage, batch_id)
        missing = [F.when(F.coalesce(F.col(c), F.lit(0)) == 0, f"missing {c}") for c in ("review_id", "product_id", "customer_id")]
        judged = self._judged(batch, schemas.ORDER_MESSAGE, F.coalesce(*missing))
        ok = judged.filter("reason IS NULL").drop("reason", "value", "key")
        first = merge.first_wins(ok, "review_id").persist()
        self._write_orders(first, self._time(stage, batch_id), stage, batch_id)
        self._finish(stage, batch_id, judged)
        first.unpersist()
        judged.unpersist()

    def on_sentiment(self, batch: DataFrame, batch_id: int) -> None:
        """Scoring messages, of new reviews or from the backfill queue: each review keeps its first score."""
        stage = "sentiment"
        self._settle(stage, batch_id)
        missing = F.when(F.coalesce(F.col("review_id"), F.lit(0)) == 0, "missing review_id")
        judged = self._judged(batch, schemas.SENTIMENT_MESSAGE, missing)
        ok = judged.filter("reason IS NULL").select("seq", "review_id", "comment")
        scored = self.scorer(merge.first_wins(ok, "review_id").drop("seq"))
        rows = sentiment.sentiment_rows(scored, self._time(stage, batch_id)).withColumn("order_at", _place(batch_id))
        self.sentiment.append(rows, stage, batch_id)
        self._finish(stage, batch_id, judged)
        judged.unpersist()

    def on_shops(self, batch: DataFrame, batch_id: int) -> None:
        """Flat shop items: names of shops, the last message of each winning."""
        stage = "shops"
        self._settle(stage, batch_id)
        read = messages.json_messages(batch.withColumn("body", F.col("value")), schemas.SHOP_MESSAGE)
        broken = F.when(F.size("violations") > 0, F.array_join("violations", ","))
        reason = F.when(F.col("corrupt").isNotNull(), "not a JSON object").otherwise(broken)
        checked = quality.with_violations(read, quality.SHOP).withColumn("reason", reason)
        judged = checked.withColumnRenamed("body", "value").drop("violations", "corrupt").persist()
        order = _order(3, batch_id).alias("order_at")
        named = judged.filter("reason IS NULL").select("shop_id", "shop_name", order)
        self.shops.append(named, stage, batch_id)
        self._finish(stage, batch_id, judged)
        judged.unpersist()

    def run(self, stream: DataFrame, stage: Callable[[DataFrame, int], None], name: str) -> None:
        """Feed everything available to a stage; progress is kept in the stage's checkpoint."""
        (
            stream.writeStream.foreachBatch(stage)
            .option("checkpointLocation", f"{self.root}/checkpoints/{name}")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
