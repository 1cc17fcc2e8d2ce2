"""Sorts with a limit.  Each ends in the primary key, so results are the same on every run.

PostgreSQL sorts nulls first when descending; Spark does not, so it is written out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martlens.functions import ordered, scalars as X
from martlens.operators import joins


def top_selling(products: DataFrame, n: int = 100) -> DataFrame:
    return products.orderBy(F.desc_nulls_first("sold_count"), "product_id").limit(n)


def top_selling_products(
    products: DataFrame, shops: DataFrame, categories: DataFrame, prices: DataFrame, n: int = 100
) -> DataFrame:
    """The n best sellers with shop, category and latest price.

    The top n are taken first (n rows per task, no sort of the table); only their prices
    are then looked up.
    """
    best = top_selling(
        products.select(
            "product_id", "name", "shop_id", "category_id", "rating", "sold_count", "review_count"
        ),
        n,
    )
    price = joins.latest_price(
        prices.select("product_id", "price", "discount_percent", "timestamp").join(
            best.select("product_id"), "product_id", "left_semi"
        )
    )
    return (
        joins.with_dimensions(best, shops, categories)
        .join(price.drop("price_timestamp"), "product_id", "left")
        .select(
            "product_id",
            "name",
            "shop_name",
            "category_name",
            "rating",
            "sold_count",
            "review_count",
            "price",
            "discount_percent",
        )
        .orderBy(F.desc_nulls_first("sold_count"), "product_id")
    )


def helpful_reviews(reviews: DataFrame, k: int = 10, text: int = 100) -> DataFrame:
    """The k most helpful reviews of every product, with the start of the comment."""
    # only the preview of a comment goes through the sort
    narrow = reviews.select(
        "product_id",
        "review_id",
        "user_name",
        "rating",
        "helpful_count",
        X.preview("comment", text).alias("comment_preview"),
    )
    order = [F.desc_nulls_first("helpful_count"), F.col("review_id")]
    return ordered.top_per_group(narrow, ["product_id"], order, k)


def newest(df: DataFrame, time: str, key: str, n: int = 10) -> DataFrame:
    return df.orderBy(F.desc_nulls_first(time), key).limit(n)


def newest_products(products: DataFrame, n: int = 10) -> DataFrame:
    return newest(
        products.select("product_id", "name", "rating", "sold_count", "first_seen"), "first_seen", "product_id", n
    )


def newest_reviews(reviews: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    """Newest reviews of known products, with the product name.

    Reviews without a product leave before the limit; names are looked up for n rows only.
    """
    wanted = reviews.select("review_id", "product_id", "user_name", "rating", "comment", "created_at")
    latest = newest(joins.with_parent(wanted, products, "product_id"), "created_at", "review_id", n)
    names = products.select("product_id", F.col("name").alias("product_name"))
    return latest.join(names, "product_id")


def newest_scored(reviews: DataFrame, sentiment: DataFrame, n: int = 10) -> DataFrame:
    """Newest scored reviews; sentiment without a review leaves before the limit."""
    latest = newest(joins.with_parent(sentiment, reviews, "review_id"), "processed_at", "review_id", n)
    return reviews.select("review_id", "rating", "comment").join(latest, "review_id")


def latest_runs(logs: DataFrame, n: int = 10, prefix: str = "") -> DataFrame:
    """The newest crawl runs whose type starts with the prefix."""
    chosen = logs.filter(F.col("crawler_type").startswith(prefix)) if prefix else logs
    return newest(chosen, "started_at", "log_id", n)


def crawl_progress(categories: DataFrame) -> DataFrame:
    """Active categories, last crawled first, never crawled last."""
    return (
        categories.filter("is_active")
        .select(
            "category_id",
            "category_name",
            "last_crawled_page",
            "total_products_crawled",
            "crawl_status",
            "last_crawled_at",
        )
        .orderBy(F.desc_nulls_last("last_crawled_at"), "category_id")
    )


def in_chunks(rows: DataFrame, key: str, batch_size: int) -> DataFrame:
    """Number the rows by key and cut them into batches, without sorting them in one task."""
    numbered = ordered.with_row_number(rows, [], key)
    chunk = F.floor((F.col("row_number") - 1) / batch_size).cast("bigint")
    return numbered.withColumn("chunk", chunk)


def by_confidence(rows: DataFrame, n: int) -> DataFrame:
    return rows.orderBy(F.desc_nulls_first("confidence_score"), "review_id").limit(n)


def top_by(df: DataFrame, order: Column, key: str, n: int) -> DataFrame:
    return df.orderBy(order, key).limit(n)
