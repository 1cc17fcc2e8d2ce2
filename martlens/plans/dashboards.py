"""Dashboard reports over the model."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from martlens.functions import ordered, scalars as X
from martlens.operators import aggregates, joins, prices as P


def product_stats_daily(
    products: DataFrame, shops: DataFrame, categories: DataFrame, prices: DataFrame
) -> DataFrame:
    """Products with shop, category, latest price and the day of that price."""
    facts = products.select(
        "product_id", "name", "shop_id", "category_id", "rating", "sold_count", "review_count", "discount_rate"
    )
    history = prices.select("product_id", "price", "original_price", "discount_percent", "timestamp")
    priced = joins.with_latest_price(facts, history)
    return joins.with_dimensions(priced, shops, categories).select(
        "product_id",
        "name",
        "shop_id",
        "shop_name",
        "category_id",
        "category_name",
        "rating",
        "sold_count",
        "review_count",
        "discount_rate",
        "price",
        "original_price",
        "discount_percent",
        F.to_date("price_timestamp").alias("date"),
    )


def overview(products: DataFrame, reviews: DataFrame, shops: DataFrame, logs: DataFrame) -> DataFrame:
    """Totals as (metric, value) rows: tables, and crawl runs that succeeded or failed."""
    sizes = aggregates.table_counts({"products": products, "reviews": reviews, "shops": shops})
    sizes = sizes.filter("table_name != 'TOTAL'").select(F.col("table_name").alias("metric"), F.col("n_rows").alias("value"))
    runs = logs.agg(
        F.count_if(F.col("status") == "completed").alias("crawls_completed"),
        F.count_if(F.col("status") == "failed").alias("crawls_failed"),
    ).unpivot([], ["crawls_completed", "crawls_failed"], "metric", "value")
    return sizes.unionByName(runs)


def category_price_percentiles(products: DataFrame, prices: DataFrame, categories: DataFrame) -> DataFrame:
    """Exact quartiles of the latest price per category."""
    latest = joins.latest_price(prices.select("product_id", "price", "timestamp"))
    cents = (F.col("price") * 100).cast("bigint")
    priced = products.select("product_id", "category_id").join(latest, "product_id").select("category_id", cents.alias("cents"))
    quartiles = {"p25": 0.25, "median": 0.5, "p75": 0.75}
    # a price has at most twelve digits, so its cents are below 2^40
    found = ordered.exact_percentiles(priced, ["category_id"], "cents", quartiles, value_bits=40)
    money = lambda c: F.round(F.col(c) / 100, 4).alias(c)
    return found.join(categories.select("category_id", "category_name"), "category_id").select(
        "category_name", "n_values", money("p25"), money("median"), money("p75")
    )


def category_price_histogram(
    products: DataFrame, prices: DataFrame, categories: DataFrame, width: int = 10000
) -> DataFrame:
    """Products per category and price band of fixed width."""
    latest = joins.latest_price(prices.select("product_id", "price", "timestamp"))
    band = (F.floor(F.col("price") / width) * width).cast("bigint")
    return (
        products.select("product_id", "category_id")
        .join(latest, "product_id")
        .groupBy("category_id", band.alias("price_from"))
        .agg(F.count("*").alias("n_products"))
        .join(categories.select("category_id", "category_name"), "category_id")
        .select("category_name", "price_from", (F.col("price_from") + width).alias("price_below"), "n_products")
    )


def highly_rated(products: DataFrame, at_least: float = 4.5) -> DataFrame:
    good = products.filter(F.col("rating") >= F.lit(at_least).cast("decimal(3,2)"))
    return good.select("product_id", "name", "rating", "review_count").orderBy(F.desc("rating"), "product_id")


def biggest_discounts(products: DataFrame, prices: DataFrame, n: int = 20) -> DataFrame:
    """Known products with the largest discount on their latest price."""
    latest = joins.latest_price(prices.select("product_id", "price", "original_price", "discount_percent", "timestamp"))
    best = joins.with_parent(latest, products, "product_id").orderBy(F.desc_nulls_last("discount_percent"), "product_id").limit(n)
    return best.join(products.select("product_id", "name"), "product_id").select(
        "product_id", "name", "price", "original_price", "discount_percent"
    )


def most_volatile(products: DataFrame, prices: DataFrame, n: int = 20) -> DataFrame:
    known = joins.with_parent(P.fluctuation(prices), products, "product_id")
    best = known.orderBy(F.desc_nulls_last("span"), "product_id").limit(n)
    return best.join(products.select("product_id", "name"), "product_id")


def average_price(products: DataFrame, prices: DataFrame, by: str, names: DataFrame, name: str) -> DataFrame:
    """Mean latest price per category or shop."""
    latest = joins.latest_price(prices.select("product_id", "price", "timestamp"))
    per_group = (
        products.select("product_id", by)
        .join(latest, "product_id")
        .groupBy(by)
        .agg(X.mean(F.sum("price"), F.count("price")).alias("avg_price"), F.count("*").alias("n_products"))
    )
    return per_group.join(names.select(by, name), by, "left").select(by, name, "avg_price", "n_products")


def price_moves(products: DataFrame, prices: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Chronological changes with their direction."""
    changes = P.price_changes(products, prices, as_of, days, order="chronological")
    return changes.withColumn("direction", F.when(F.col("price_difference") > 0, "up").otherwise("down"))


def price_drops(
    products: DataFrame, prices: DataFrame, as_of: Column, days: int = 7, percent: float = 10.0
) -> DataFrame:
    """Drops of at least `percent` per cent."""
    changes = P.price_changes(products, prices, as_of, days, order="chronological")
    return changes.filter(F.col("price_change_percent") <= -percent)


def ranked_by_sentiment(summary: DataFrame, label: str, min_reviews: int = 3, n: int = 10) -> DataFrame:
    """Products with the largest share of one label among enough reviews."""
    share = X.ratio(F.col(f"{label}_count"), F.col("total_reviews"))
    return (
        summary.filter(F.col("total_reviews") >= min_reviews)
        .withColumn("share", share)
        .orderBy(F.desc_nulls_last("share"), F.desc("total_reviews"), "product_id")
        .limit(n)
        .select("product_id", "name", "total_reviews", f"{label}_count", "share")
    )


def keyword_counts(
    reviews: DataFrame, text: str = "comment", stop_words: tuple[str, ...] = (), min_length: int = 2
) -> DataFrame:
    """Reviews' words and how often they occur, without stop words."""
    found = reviews.select(F.explode(X.words(text, min_length)).alias("word"))
    kept = found.filter(~F.col("word").isin(*stop_words)) if stop_words else found
    return kept.groupBy("word").agg(F.count("*").alias("n"))


def keyword_cloud(reviews: DataFrame, n: int = 100, **options) -> DataFrame:
    return keyword_counts(reviews, **options).orderBy(F.desc("n"), "word").limit(n)


def weekly_sentiment(reviews: DataFrame, sentiment: DataFrame) -> DataFrame:
    """Scored and positive reviews per product and week."""
    week = F.to_date(F.date_trunc("week", "processed_at")).alias("week")
    return (
        reviews.select("review_id", "product_id")
        .join(sentiment.select("review_id", "sentiment", "processed_at"), "review_id")
        .groupBy("product_id", week)
        .agg(F.count("*").alias("n"), F.count_if(F.col("sentiment") == "positive").alias("positive"))
    )


def declining_sentiment(products: DataFrame, reviews: DataFrame, sentiment: DataFrame, min_weeks: int = 2) -> DataFrame:
    """Products whose weekly positive share falls, by the slope of a least-squares line."""
    weekly = weekly_sentiment(reviews, sentiment)
    share = F.col("positive").cast("double") / F.col("n")
    week_no = (F.datediff("week", F.lit("1970-01-01").cast("date")) / 7).cast("double")
    slopes = weekly.groupBy("product_id").agg(
        F.count("*").alias("weeks"), F.round(F.regr_slope(share, week_no), 6).alias("slope")
    )
    falling = slopes.filter((F.col("weeks") >= min_weeks) & (F.col("slope") < 0))
    return falling.join(products.select("product_id", "name"), "product_id")


def most_reviewed(products: DataFrame, reviews: DataFrame, n: int = 10) -> DataFrame:
    known = joins.with_parent(aggregates.review_counts(reviews), products, "product_id")
    best = known.orderBy(F.desc("n_reviews"), "product_id").limit(n)
    return best.join(products.select("product_id", "name"), "product_id")


def rating_sales_correlation(products: DataFrame) -> DataFrame:
    return products.agg(
        F.round(F.corr(F.col("rating").cast("double"), F.col("sold_count").cast("double")), 6).alias("correlation"),
        F.count_if(F.col("rating").isNotNull() & F.col("sold_count").isNotNull()).alias("n_products"),
    )


def shop_comparison(products: DataFrame, prices: DataFrame, shops: DataFrame) -> DataFrame:
    """Products, mean rating, units sold and mean latest price per shop."""
    latest = joins.latest_price(prices.select("product_id", "price", "timestamp"))
    per_shop = (
        products.select("product_id", "shop_id", "rating", "sold_count")
        .join(latest, "product_id", "left")
        .groupBy("shop_id")
        .agg(
            F.count("*").alias("n_products"),
            X.mean(F.sum("rating"), F.count("rating")).alias("avg_rating"),
            F.sum("sold_count").alias("units_sold"),
            X.mean(F.sum("price"), F.count("price")).alias("avg_price"),
        )
    )
    return shops.select("shop_id", "shop_name", "is_official").join(per_shop, "shop_id")


def top_shops(comparison: DataFrame, by: str, n: int = 10) -> DataFrame:
    """The n best shops with their place; only n rows reach the numbering."""
    best = comparison.orderBy(F.desc_nulls_last(by), "shop_id").limit(n)
    place = F.row_number().over(Window.partitionBy().orderBy(F.desc_nulls_last(by), "shop_id"))
    return best.withColumn("place", place)


def product_scores(products: DataFrame, summary: DataFrame, min_reviews: int = 3) -> DataFrame:
    """Half rating, half positive share, for products with enough reviews."""
    positive = F.col("positive_count").cast("double") / F.col("total_reviews")
    score = F.lit(0.5) * F.col("rating").cast("double") / 5 + F.lit(0.5) * positive
    return (
        products.select("product_id", "category_id", "rating")
        .join(summary.select("product_id", "total_reviews", "positive_count"), "product_id")
        .filter((F.col("total_reviews") >= min_reviews) & F.col("rating").isNotNull())
        .select("product_id", "category_id", F.round(score, 6).alias("score"))
    )


def recommendations(products: DataFrame, scores: DataFrame, k: int = 3) -> DataFrame:
    """For each product the k best others of its category.

    Only the k + 1 best of a category are joined, so a product meets at most k + 1
    candidates, itself among them or not.
    """
    best = ordered.top_per_group(scores, ["category_id"], [F.desc("score"), F.col("product_id")], k + 1)
    picks = best.select(
        "category_id",
        F.col("product_id").alias("recommended_id"),
        "score",
        F.col("rank").alias("_rank"),
    )
    own = best.select("product_id", F.col("rank").alias("_own"))
    paired = (
        products.select("product_id", "category_id")
        .join(own, "product_id", "left")
        .join(picks, "category_id")
        .filter(F.col("recommended_id") != F.col("product_id"))
    )
    behind_self = F.coalesce(F.col("_rank") > F.col("_own"), F.lit(False)).cast("int")
    return (
        paired.withColumn("place", F.col("_rank") - behind_self)
        .filter(F.col("place") <= k)
        .select("product_id", "place", "recommended_id", "score")
    )


def trending(products: DataFrame, reviews: DataFrame, as_of: Column, days: int = 7, n: int = 10) -> DataFrame:
    """Products whose reviews grew most over the period before, by ratio (+1 smoothed)."""
    middle, start = P.since(as_of, days), P.since(as_of, 2 * days)
    recent = reviews.filter(F.col("created_at") > start).groupBy("product_id").agg(
        F.count_if(F.col("created_at") > middle).alias("recent"),
        F.count_if(F.col("created_at") <= middle).alias("before"),
    )
    growth = F.round((F.col("recent") + 1) / (F.col("before") + 1), 4)
    best = (
        joins.with_parent(recent.filter("recent > 0"), products, "product_id")
        .withColumn("growth", growth)
        .orderBy(F.desc("growth"), F.desc("recent"), "product_id")
        .limit(n)
    )
    return best.join(products.select("product_id", "name"), "product_id")


def starters(products: DataFrame, prices: DataFrame, categories: DataFrame) -> DataFrame:
    """Opening figures: products in all and per category, and the mean latest price."""
    total = products.agg(F.lit("total_products").alias("metric"), F.count("*").cast("double").alias("value"))
    per_category = (
        products.groupBy("category_id")
        .agg(F.count("*").alias("n"))
        .join(categories.select("category_id", "category_name"), "category_id")
        .select(F.concat(F.lit("products in "), "category_name").alias("metric"), F.col("n").cast("double").alias("value"))
    )
    latest = joins.latest_price(prices.select("product_id", "price", "timestamp"))
    mean = latest.agg(F.lit("average_price").alias("metric"), X.mean(F.sum("price"), F.count("price")).alias("value"))
    return reduce(DataFrame.unionByName, [total, per_category, mean])
