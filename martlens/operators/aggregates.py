"""Counts, shares and summaries.  Everything is partially aggregated before its shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from martlens.functions import scalars as X


def sentiment_counts(prefix: str = "") -> list[Column]:
    label = F.col(f"{prefix}sentiment")
    return [
        F.count_if(label == "positive").alias("positive_count"),
        F.count_if(label == "negative").alias("negative_count"),
        F.count_if(label == "neutral").alias("neutral_count"),
    ]


def sentiment_summary(products: DataFrame, reviews: DataFrame, sentiment: DataFrame) -> DataFrame:
    """Per product: reviews, reviews per label, share of positive ones, mean confidence.

    Reviews are reduced per product before the products are joined, so the fan-out of the
    three-way left join never happens.
    """
    per_product = (
        reviews.select("review_id", "product_id")
        .join(sentiment.select("review_id", "sentiment", "confidence_score"), "review_id", "left")
        .groupBy("product_id")
        .agg(
            F.count("*").alias("total_reviews"),
            *sentiment_counts(),
            F.sum("confidence_score").alias("_sum"),
            F.count("confidence_score").alias("_n"),
        )
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return (
        products.select("product_id", "name")
        .join(per_product, "product_id", "left")
        .select(
            "product_id",
            "name",
            zero("total_reviews"),
            zero("positive_count"),
            zero("negative_count"),
            zero("neutral_count"),
            X.ratio(F.col("positive_count"), F.col("total_reviews")).alias("positive_percentage"),
            X.mean(F.col("_sum"), F.col("_n"), 6).alias("avg_confidence"),
        )
    )


def scored_product_summary(products: DataFrame, reviews: DataFrame, sentiment: DataFrame) -> DataFrame:
    """The same over scored reviews only, without products that have none."""
    per_product = (
        reviews.select("review_id", "product_id")
        .join(sentiment.select("review_id", "sentiment", "confidence_score"), "review_id")
        .groupBy("product_id")
        .agg(
            F.count("*").alias("total_reviews"),
            *sentiment_counts(),
            X.mean(F.sum("confidence_score"), F.count("confidence_score")).alias("avg_confidence"),
        )
    )
    names = products.select("product_id", F.col("name").alias("product_name"))
    return per_product.join(names, "product_id")


def distribution(df: DataFrame, column: str, *extra: Column) -> DataFrame:
    """Rows per value and their share of all rows.

    Meant for columns with few values (stars, labels): the window sees one row per value.
    """
    counted = df.groupBy(column).agg(F.count("*").alias("n"), *extra)
    everything = F.sum("n").over(Window.partitionBy())
    return counted.withColumn("percentage", X.ratio(F.col("n"), everything))


def sentiment_distribution(sentiment: DataFrame) -> DataFrame:
    confidence = X.mean(F.sum("confidence_score"), F.count("confidence_score")).alias("avg_confidence")
    return distribution(sentiment, "sentiment", confidence)


def rating_distribution(reviews: DataFrame) -> DataFrame:
    return distribution(reviews, "rating")


def review_stats(reviews: DataFrame) -> DataFrame:
    """Per product: reviews, mean stars, reviews with photos."""
    return reviews.groupBy("product_id").agg(
        F.count("*").alias("review_count"),
        X.mean(F.sum("rating"), F.count("rating")).alias("avg_rating"),
        F.count_if("has_images").alias("with_photos"),
    )


def review_counts(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("product_id").agg(F.count("*").alias("n_reviews"))


def sentiment_trend(sentiment: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Scored reviews per day and label since the day `days` before `as_of`."""
    since = F.date_trunc("day", as_of) - F.make_dt_interval(days=F.lit(days))
    recent = sentiment.filter(F.col("processed_at") >= since)
    return recent.groupBy(F.to_date("processed_at").alias("day"), "sentiment").agg(F.count("*").alias("n"))


def products_per_hour(products: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    since = as_of - F.make_dt_interval(hours=F.lit(hours))
    fresh = products.filter(F.col("first_seen") > since)
    return fresh.groupBy(X.hour_of("first_seen").alias("hour")).agg(F.count("*").alias("products_count"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table and their total."""
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count("*").alias("n_rows"))
        for name, df in tables.items()
    ]
    listed = reduce(DataFrame.unionByName, counts)
    total = listed.agg(F.lit("TOTAL").alias("table_name"), F.sum("n_rows").alias("n_rows"))
    return listed.unionByName(total)


def sentiment_coverage(reviews: DataFrame, sentiment: DataFrame) -> DataFrame:
    """Reviews, scored reviews, the rest and the share that is scored."""
    sizes = reviews.select(F.lit(1).alias("r"), F.lit(0).alias("s")).unionAll(
        sentiment.select(F.lit(0), F.lit(1))
    )
    total, scored = F.sum("r"), F.sum("s")
    return sizes.agg(
        F.coalesce(total, F.lit(0)).alias("total_reviews"),
        F.coalesce(scored, F.lit(0)).alias("scored_reviews"),
        F.coalesce(total - scored, F.lit(0)).alias("unscored_reviews"),
        F.coalesce(X.ratio(scored, total), F.lit(0.0)).alias("coverage_percent"),
    )


def ordered_names(df: DataFrame, keys: Sequence[str], name: str, out: str = "place") -> DataFrame:
    """The distinct names of each group, numbered in order.

    One row per name: a group may have any number of them, so they are not joined into one text.
    """
    distinct = df.select(*keys, name).distinct()
    return distinct.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(name)))
