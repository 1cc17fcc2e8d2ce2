"""Joins of the model.

No side is forced to broadcast: Catalyst and AQE broadcast only what they measured to be
small.  Parents have one row per key, so a hot key is hot on the child side only, which
AQE can split; where the result is aggregated, children are pre-aggregated instead.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from martlens.session import work_dir

PRICE_COLUMNS = ("price", "original_price", "discount_percent", "stock_available")


def latest_price(prices: DataFrame, as_of: Column | None = None) -> DataFrame:
    """The newest price row of each product, at or before `as_of`.

    One max_by per fixed-width column keeps the aggregation hash-based and partial;
    (product_id, timestamp) is unique, so all of them pick the same row.
    """
    if as_of is not None:
        prices = prices.filter(F.col("timestamp") <= as_of)
    present = [c for c in PRICE_COLUMNS if c in prices.columns]
    return prices.groupBy("product_id").agg(
        *[F.max_by(c, "timestamp").alias(c) for c in present],
        F.max("timestamp").alias("price_timestamp"),
    )


def with_dimensions(products: DataFrame, shops: DataFrame, categories: DataFrame) -> DataFrame:
    """Products with shop and category names; unmatched products stay."""
    return products.join(shops.select("shop_id", "shop_name"), "shop_id", "left").join(
        categories.select("category_id", "category_name"), "category_id", "left"
    )


def with_latest_price(products: DataFrame, prices: DataFrame) -> DataFrame:
    return products.join(latest_price(prices), "product_id", "left")


def order_details(
    orders: DataFrame, customers: DataFrame, lines: DataFrame, products: DataFrame
) -> DataFrame:
    """Order lines with customer and product names."""
    return (
        lines.select("order_id", "product_id", "quantity", "unit_price")
        .join(orders.select("order_id", "customer_id", "total_amount", "order_date"), "order_id")
        .join(customers.select("customer_id", "customer_name"), "customer_id")
        .join(products.select("product_id", F.col("name").alias("product_name")), "product_id")
        .select(
            "order_id",
            "customer_name",
            "product_name",
            "quantity",
            "unit_price",
            "total_amount",
            "order_date",
        )
    )


def scored_reviews(reviews: DataFrame, sentiment: DataFrame) -> DataFrame:
    """Reviews that have a sentiment, with it."""
    return reviews.join(
        sentiment.select("review_id", "sentiment", "confidence_score", "processed_at"), "review_id"
    )


def without_match(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key does not occur in `done`: reviews without orders, without sentiment."""
    return rows.join(done.select(key), key, "left_anti")


def with_parent(rows: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose parent exists."""
    return rows.join(parents.select(key), key, "left_semi")


def orphans(rows: DataFrame, parents: DataFrame, key: str, reason: str) -> DataFrame:
    """Rows whose parent is missing, with the reason they are held back."""
    lost = rows.join(parents.select(key), key, "left_anti")
    return lost.withColumn("reason", F.lit(reason))


def parent_names(categories: DataFrame) -> DataFrame:
    """Each category with its parent's name."""
    parent = categories.select(
        F.col("category_id").alias("parent_id"), F.col("category_name").alias("parent_name")
    )
    return categories.join(parent, "parent_id", "left").select(
        "category_id", "category_name", "parent_id", "parent_name"
    )


def category_paths(categories: DataFrame) -> DataFrame:
    """Full path of each category from its root, however deep it lies.

    Pointer doubling: after k rounds a category knows the 2^k categories from itself upwards and the one that follows them,
    whose own 2^k the next round appends, so a tree of depth d takes log2(d) rounds.  Only open categories are
    written again; those that ended stay in the folder of their round.  A category whose chain runs into a circle has
    `complete` false; its path then names every category of the chain once.  A missing parent ends a path like a root
    does, and a category without a name is left out of the paths.
    """
    spark, folder = categories.sparkSession, work_dir(categories.sparkSession, "paths")
    now = categories.select(
        "category_id",
        F.array("category_id").alias("ids"),
        F.array("category_name").alias("names"),
        F.col("parent_id").alias("next"),
        F.lit(True).alias("complete"),
    )
    ended: list[DataFrame] = []
    while True:
        path = f"{folder}/{len(ended)}"
        now.write.parquet(path)
        now = spark.read.schema(now.schema).parquet(path)
        ended.append(now.filter("next IS NULL"))
        todo = now.filter("next IS NOT NULL")
        if todo.isEmpty():
            break
        known = reduce(DataFrame.unionByName, ended, todo)
        above = known.select(F.col("category_id").alias("_up"), *[F.col(c).alias(f"_{c}") for c in ("ids", "names", "next", "complete")])
        longer = lambda c: F.coalesce(F.concat(c, f"_{c}"), c)
        joined = todo.join(above, F.col("next") == F.col("_up"), "left").select(
            "category_id",
            longer("ids").alias("ids"),
            longer("names").alias("names"),
            F.col("_next").alias("next"),
            F.coalesce("_complete", F.lit(True)).alias("complete"),
        )
        # a chain that comes to a category again goes on in a circle from there
        once = F.array_distinct("ids")
        closes = F.size(once) < F.size("ids")
        now = joined.select(
            "category_id",
            once.alias("ids"),
            F.slice("names", 1, F.size(once)).alias("names"),
            F.when(~closes, F.col("next")).alias("next"),
            (F.col("complete") & ~closes).alias("complete"),
        )
    return reduce(DataFrame.unionByName, ended).select(
        "category_id",
        F.array_join(F.reverse("names"), " / ").alias("path"),
        F.size("ids").alias("depth"),
        "complete",
    )
