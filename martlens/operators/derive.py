"""Facts derived from reviews: one review is one order by its author."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from martlens.functions import scalars as X
from martlens.functions.ordered import as_of_join
from martlens.operators import joins, merge

# Fixed value: unit price used by the backfill when a product has no price.
BACKFILL_PRICE = 100000


def order_facts(
    messages: DataFrame,
    products: DataFrame,
    prices: DataFrame,
    existing_orders: DataFrame | None = None,
    now: Column | None = None,
    as_of: Column | None = None,
    keep: Sequence[str] = (),
    own_time: bool = False,
    once: bool = False,
) -> DataFrame:
    """Order messages to order rows with their single line.

    The price is the newest, or the newest at `as_of`, or with `own_time` the newest at each order's date.

    Messages without a review, product or customer id, and those of unknown products, give no
    order; of repeated reviews the first wins, and `once` says that none repeats.  The order id is the review id
    (both are unique).
    """
    given = messages
    for c in ("review_id", "product_id", "customer_id"):
        given = given.filter(F.coalesce(F.col(c), F.lit(0)) != 0)
    known = joins.with_parent(given, products, "product_id")
    if existing_orders is not None:
        known = joins.without_match(known, existing_orders, "review_id")
    fresh = merge.first_wins(known, "review_id") if "seq" in known.columns and not once else known
    if dict(messages.dtypes)["order_date"] == "string":
        fresh = fresh.withColumn("order_date", X.moment("order_date", now if now is not None else F.current_timestamp()))
    priced = _priced(fresh, prices, "order_date" if own_time else None, as_of)
    return priced.select(
        *keep,
        F.col("review_id").alias("order_id"),
        "customer_id",
        "review_id",
        "product_id",
        "order_date",
        F.lit(1).alias("quantity"),
        F.col("price").alias("unit_price"),
        # a price of zero gives no total
        F.when(F.col("price") != 0, F.col("price")).alias("total_amount"),
        F.lit("completed").alias("status"),
    )


def _priced(rows: DataFrame, prices: DataFrame, time: str | None, as_of: Column | None = None) -> DataFrame:
    """Rows with the price of their product: in force at the row's own time, or the newest one."""
    if time is not None:
        return as_of_join(rows, prices, "product_id", time, "timestamp", ["price"])
    price = joins.latest_price(prices.select("product_id", "price", "timestamp"), as_of)
    return rows.join(price.select("product_id", "price"), "product_id", "left")


def orders_of(facts: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return facts.select(*keep, "order_id", "customer_id", "review_id", "order_date", "total_amount", "status")


def order_lines_of(facts: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return facts.select(
        *keep,
        F.col("order_id").alias("order_line_id"),
        "order_id",
        "product_id",
        "quantity",
        "unit_price",
        (F.col("unit_price") * F.col("quantity")).cast("decimal(12,2)").alias("subtotal"),
    )


def customers_of(messages: DataFrame, seq: str = "seq") -> DataFrame:
    """Each customer with the last name a review gave."""
    known = messages.filter(F.coalesce(F.col("customer_id"), F.lit(0)) != 0)
    return known.groupBy("customer_id").agg(
        F.coalesce(F.max_by("customer_name", seq), F.lit("Anonymous")).alias("customer_name")
    )


def backfill_orders(
    reviews: DataFrame, orders: DataFrame, products: DataFrame, prices: DataFrame, own_time: bool = False
) -> DataFrame:
    """Orders for stored reviews that have none; the customer id is made from the user name.

    The price is the newest, or with `own_time` the one in force when the review was written.
    """
    todo = joins.with_parent(joins.without_match(reviews, orders, "review_id"), products, "product_id")
    paid = F.coalesce(F.nullif("price", F.lit(0)), F.lit(BACKFILL_PRICE)).cast("decimal(12,2)")
    return _priced(todo, prices, "created_at" if own_time else None).select(
        F.col("review_id").alias("order_id"),
        X.name_id("user_name").alias("customer_id"),
        F.col("user_name").alias("customer_name"),
        "review_id",
        "product_id",
        F.col("created_at").alias("order_date"),
        F.lit(1).alias("quantity"),
        paid.alias("unit_price"),
        paid.alias("total_amount"),
        F.lit("completed").alias("status"),
    )


def backfill_sentiment_queue(
    reviews: DataFrame, sentiment: DataFrame, limit: int | None = None
) -> DataFrame:
    """Unscored reviews, lowest ids first when a limit is asked for."""
    todo = joins.without_match(reviews, sentiment, "review_id")
    return todo if limit is None else todo.orderBy("review_id").limit(limit)


def backfill_size(reviews: DataFrame, sentiment: DataFrame) -> DataFrame:
    """The dry run: how many reviews a backfill would queue."""
    todo = joins.without_match(reviews.select("review_id"), sentiment, "review_id")
    return todo.agg(F.count("*").alias("to_queue"))
