"""The data model derived from the sample star schema, lazily and per table."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

SITE = "https://shop.example/"
# The stored times have no zone; they are read as such and taken as UTC.
TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": (
        "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
        "p_retailprice DOUBLE"
    ),
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
        "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
        "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"
    ),
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
        "props STRING"
    ),
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
}


def n_rows(df: DataFrame) -> Column:
    """Row count as a scalar subquery, answered from the file footers."""
    return df.select(F.count("*")).scalar()


class SampleModel:
    """Tables of the model, each a DataFrame over the files of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._scans: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._scans:
            df = self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}.parquet")
            zoneless = [c for c, t in df.dtypes if t == "timestamp_ntz"]
            self._scans[name] = df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless})
        return self._scans[name]

    @cached_property
    def categories(self) -> DataFrame:
        """One row per product type, numbered in order; only the distinct names are sorted."""
        names = self.raw("part").select("p_type").distinct()
        return names.select(
            F.row_number().over(Window.orderBy("p_type")).alias("category_id"),
            F.col("p_type").alias("category_name"),
            F.lit(None).cast("int").alias("parent_id"),
        )

    @cached_property
    def deep_tree(self) -> DataFrame:
        """Chains of parts twelve deep, some circular: a tree whose depth is not known beforehand."""
        key = F.col("p_partkey")
        up = F.when(key % 12 > 0, key - 1).when(key % 60 == 48, key + 11)
        return self.raw("part").select(
            key.alias("category_id"), F.col("p_brand").alias("category_name"), up.alias("parent_id")
        )

    @cached_property
    def category_tree(self) -> DataFrame:
        roots = self.raw("region").select(
            F.col("r_regionkey").alias("category_id"),
            F.col("r_name").alias("category_name"),
            F.lit(None).cast("int").alias("parent_id"),
        )
        leaves = self.raw("nation").select(
            (F.col("n_nationkey") + 100).alias("category_id"),
            F.col("n_name").alias("category_name"),
            F.col("n_regionkey").alias("parent_id"),
        )
        return roots.unionByName(leaves)

    @cached_property
    def shops(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.raw("supplier").select(
            key.alias("shop_id"),
            F.col("s_name").alias("shop_name"),
            (key % 12 * F.lit(0.5).cast("decimal(2,1)")).cast("decimal(3,2)").alias("rating"),
            (key * 7 % 110).cast("int").alias("response_rate"),
            (key * 13 % 5000 - 10).cast("int").alias("follower_count"),
            (key % 10 == 0).alias("is_official"),
        )

    @cached_property
    def product_prices(self) -> DataFrame:
        price = F.col("l_extendedprice").cast("decimal(12,2)")
        percent = F.round(F.col("l_discount") * 100).cast("int")
        return (
            self.raw("lineitem")
            .groupBy(F.col("l_partkey").alias("product_id"), F.col("l_shipdate").alias("timestamp"))
            .agg(
                F.max(price).alias("price"),
                F.max(percent).alias("discount_percent"),
                F.max(F.col("l_quantity").cast("int")).alias("stock_available"),
            )
            .select(
                "product_id",
                "price",
                (F.col("price") + 1000).cast("decimal(12,2)").alias("original_price"),
                "discount_percent",
                "stock_available",
                "timestamp",
            )
        )

    @cached_property
    def parts(self) -> DataFrame:
        """Parts for building messages."""
        return self.raw("part")

    @cached_property
    def review_facts(self) -> DataFrame:
        """Reviews without their text, which most reports never read."""
        return self._facts(self.raw("events"))

    def _facts(self, events: DataFrame) -> DataFrame:
        key = F.col("event_id")
        return events.select(
            key.alias("review_id"),
            (key % n_rows(self.raw("part"))).alias("product_id"),
            F.concat(F.lit("user_"), F.col("user_id")).alias("user_name"),
            (F.floor("value").cast("int") % 5 + 1).cast("int").alias("rating"),
            (F.col("event_type") == "view").alias("has_images"),
            F.from_json("props", "k INT").getField("k").alias("helpful_count"),
            F.col("ts").alias("created_at"),
            F.col("user_id"),
            (key % n_rows(self.raw("documents"))).alias("doc_id"),
        )

    @cached_property
    def documents(self) -> DataFrame:
        return self.raw("documents")

    @cached_property
    def pages(self) -> DataFrame:
        return self.raw("pages")

    @cached_property
    def reviews(self) -> DataFrame:
        texts = self.documents.select("doc_id", F.col("text").alias("comment"))
        return self.review_facts.join(texts, "doc_id").select(
            "review_id",
            "product_id",
            "user_name",
            "rating",
            "comment",
            "has_images",
            "helpful_count",
            "created_at",
        )

    @cached_property
    def review_sentiment(self) -> DataFrame:
        labelled = (
            self.raw("labels")
            .join(self.raw("documents").select("doc_id", "n_chars"), "doc_id")
            .select(
                "doc_id",
                F.when(F.col("toxic") == 1, "negative")
                .when(F.col("quality") == 1, "positive")
                .otherwise("neutral")
                .alias("sentiment"),
                ((F.col("n_chars") % 10000).cast("decimal(9,4)") / 10000)
                .cast("decimal(5,4)")
                .alias("confidence_score"),
            )
        )
        return (
            self.review_facts.select("doc_id", "review_id", F.col("created_at").alias("processed_at"))
            .join(labelled, "doc_id")
            .select("review_id", "sentiment", "confidence_score", "processed_at")
        )

    @cached_property
    def products(self) -> DataFrame:
        sold = (
            self.raw("lineitem")
            .groupBy(F.col("l_partkey").alias("product_id"))
            .agg(
                F.sum("l_quantity").cast("int").alias("sold"),
                F.min("l_shipdate").alias("first_seen"),
                F.max(F.round(F.col("l_discount") * 100).cast("int")).alias("discount_rate"),
            )
        )
        rated = self.review_facts.groupBy("product_id").agg(
            F.count("*").cast("int").alias("review_count"), F.sum("rating").alias("stars")
        )
        key = F.col("product_id")
        quoted = F.concat(F.lit('[{"name":"'), F.col("p_brand"), F.lit('"}]'))
        return (
            self.raw("part")
            .withColumnRenamed("p_partkey", "product_id")
            .join(sold, "product_id", "left")
            .join(rated, "product_id", "left")
            .join(self.categories.select("category_id", F.col("category_name").alias("p_type")), "p_type", "left")
            .select(
                "product_id",
                F.col("p_name").alias("name"),
                (key % n_rows(self.raw("supplier"))).alias("shop_id"),
                "category_id",
                F.concat(F.lit(SITE + "p"), key).alias("url"),
                F.col("p_brand").alias("short_description"),
                (F.col("stars").cast("decimal(20,4)") / F.col("review_count"))
                .cast("decimal(3,2)")
                .alias("rating"),
                F.when(key % 97 != 0, F.col("sold")).alias("sold_count"),
                F.coalesce("review_count", F.lit(0)).alias("review_count"),
                F.coalesce("discount_rate", F.lit(0)).alias("discount_rate"),
                "first_seen",
                F.when(key % 3 != 0, quoted).alias("authors"),
                F.when(key % 4 != 0, quoted).alias("specifications"),
            )
        )

    @cached_property
    def customers(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name")
        )

    @cached_property
    def orders(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("total_amount"),
            F.col("o_orderdate").alias("order_date"),
            F.lit("completed").alias("status"),
        )

    @cached_property
    def order_lines(self) -> DataFrame:
        price = F.col("l_extendedprice").cast("decimal(12,2)")
        return (
            self.raw("lineitem")
            .groupBy(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"))
            .agg(
                F.max("l_partkey").alias("product_id"),
                F.max(F.col("l_quantity").cast("int")).alias("quantity"),
                F.max(price).alias("unit_price"),
            )
        )

    @cached_property
    def crawl_categories(self) -> DataFrame:
        key = F.col("n_nationkey")
        states = F.array(*[F.lit(s) for s in ("pending", "in_progress", "completed", "failed", "paused")])
        start = F.lit("2024-01-01 00:00:00").cast("timestamp")
        return self.raw("nation").select(
            key.alias("category_id"),
            F.col("n_name").alias("category_name"),
            F.concat(F.lit(SITE + "c"), key).alias("category_url"),
            F.col("n_regionkey").alias("parent_category_id"),
            (key % 7 != 0).alias("is_active"),
            F.when(key % 13 != 0, key % 11).alias("priority"),
            (key * 5 % 60 + 1).alias("max_pages"),
            F.element_at(states, key % 5 + 1).alias("crawl_status"),
            F.when(key % 3 != 0, F.timestamp_add("DAY", key, start)).alias("last_crawled_at"),
            (key % 4).alias("last_crawled_page"),
            (key * 10).alias("total_products_crawled"),
            F.when(key % 5 == 3, F.concat(F.lit("Error: "), F.col("n_name"))).alias("notes"),
        )

    @cached_property
    def crawl_logs(self) -> DataFrame:
        k = F.from_json("props", "k INT").getField("k")
        kind = F.col("event_type")
        status = F.when(kind == "error", "failed").when(kind == "signup", "running").otherwise("completed")
        return self.raw("events").select(
            F.col("event_id").alias("log_id"),
            F.concat(F.lit("listing_cat_"), F.col("user_id")).alias("crawler_type"),
            status.alias("status"),
            k.alias("items_crawled"),
            F.when(kind == "error", 1).otherwise(0).alias("errors_count"),
            F.concat(F.lit("Last page: "), k).alias("error_message"),
            F.col("ts").alias("started_at"),
            F.when(kind != "signup", F.timestamp_add("SECOND", k, F.col("ts"))).alias("completed_at"),
        )

    @cached_property
    def price_time(self) -> Column:
        """Newest price time: the reports' "now"."""
        return self.raw("lineitem").select(F.max("l_shipdate")).scalar()

    @cached_property
    def review_time(self) -> Column:
        return self.raw("events").select(F.max("ts")).scalar()
