"""Contracts: named rules a row must meet, and checks over whole tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from martlens import schemas
from martlens.functions import scalars as X

Rules = dict[str, Column]


def required(name: str) -> Column:
    return F.col(name).isNotNull()


def optional(name: str, test: Column) -> Column:
    return F.col(name).isNull() | test


def length_between(name: str, low: int, high: int) -> Column:
    return F.length(name).between(low, high)


PRODUCT = {
    "product_id_required": lambda: required("product_id"),
    "shop_id_required": lambda: required("shop_id"),
    "url_required": lambda: required("url"),
    "name_length": lambda: required("name") & length_between("name", 1, 1000),
    "rating_range": lambda: optional("rating", F.col("rating").between(0, 5)),
    "sold_count_min": lambda: optional("sold_count", F.col("sold_count") >= 0),
}
REVIEW = {
    "product_id_required": lambda: required("product_id"),
    "rating_range": lambda: required("rating") & F.col("rating").between(1, 5),
    "created_at_required": lambda: required("created_at"),
    "user_name_length": lambda: optional("user_name", F.length("user_name") <= 255),
    "helpful_count_min": lambda: optional("helpful_count", F.col("helpful_count") >= 0),
}
PRICE = {
    "price_min": lambda: required("price") & (F.col("price") >= 0),
    "original_price_min": lambda: optional("original_price", F.col("original_price") >= 0),
    "discount_range": lambda: optional("discount_percent", F.col("discount_percent").between(0, 100)),
    "stock_min": lambda: optional("stock_available", F.col("stock_available") >= 0),
}
SHOP = {
    "shop_id_required": lambda: required("shop_id"),
    "shop_name_length": lambda: required("shop_name") & length_between("shop_name", 1, 255),
    "rating_range": lambda: optional("rating", F.col("rating").between(0, 5)),
    "response_rate_range": lambda: optional("response_rate", F.col("response_rate").between(0, 100)),
    "follower_count_min": lambda: optional("follower_count", F.col("follower_count") >= 0),
}
CATEGORY = {
    "category_name_length": lambda: required("category_name") & length_between("category_name", 1, 255),
}
SENTIMENT = {
    "sentiment_known": lambda: optional("sentiment", F.col("sentiment").isin(*schemas.SENTIMENTS)),
    "confidence_range": lambda: optional("confidence_score", F.col("confidence_score").between(0, 1)),
}
# Column checks the tables declare themselves.
TABLE_CHECKS = {
    "reviews": {"rating_1_5": lambda: required("rating") & F.col("rating").between(1, 5)},
    "order_lines": {"quantity_positive": lambda: required("quantity") & (F.col("quantity") > 0)},
    "crawl_categories": {
        "crawl_status_known": lambda: optional("crawl_status", F.col("crawl_status").isin(*schemas.CRAWL_STATES))
    },
    "review_sentiment": {
        "sentiment_known": lambda: required("sentiment") & F.col("sentiment").isin(*schemas.SENTIMENTS)
    },
}
# (child table, column, parent table, parent column)
FOREIGN_KEYS = (
    ("products", "shop_id", "shops", "shop_id"),
    ("products", "category_id", "categories", "category_id"),
    ("product_prices", "product_id", "products", "product_id"),
    ("reviews", "product_id", "products", "product_id"),
    ("review_sentiment", "review_id", "reviews", "review_id"),
    ("orders", "customer_id", "customers", "customer_id"),
    ("orders", "review_id", "reviews", "review_id"),
    ("order_lines", "order_id", "orders", "order_id"),
    ("order_lines", "product_id", "products", "product_id"),
)


def build(contract: dict) -> Rules:
    return {name: make() for name, make in contract.items()}


def with_violations(df: DataFrame, contract: dict) -> DataFrame:
    """Add the names of the broken rules; an undecidable rule counts as broken."""
    broken = [
        F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in build(contract).items()
    ]
    return df.withColumn("violations", F.array_compact(F.array(*broken)))


def valid_rows(df: DataFrame, contract: dict) -> DataFrame:
    checked = with_violations(df, contract)
    return checked.filter(F.size("violations") == 0).drop("violations")


def reject_rows(df: DataFrame, contract: dict) -> DataFrame:
    """Broken rows with one joined reason, ready for a rejects table."""
    checked = with_violations(df, contract).filter(F.size("violations") > 0)
    return checked.withColumn("reason", F.array_join("violations", ",")).drop("violations")


def violation_counts(df: DataFrame, contract: dict) -> DataFrame:
    """One row per rule: rows checked and rows that break it, in a single pass."""
    rules = build(contract)
    counts = [
        F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in rules.items()
    ]
    one_row = df.agg(F.count("*").alias("checked"), *counts)
    return one_row.unpivot("checked", list(rules), "rule", "violations").select(
        "rule", "checked", "violations"
    )


def missing_required(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which a required field is missing in the truthy sense, with the field names."""
    types = {f.name: f.dataType for f in df.schema}
    absent = [F.when(~X.is_truthy(c, types[c]), F.lit(c)) for c in columns]
    return df.withColumn("missing", F.array_compact(F.array(*absent))).filter(F.size("missing") > 0)


def has_required(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema}
    return df.filter(reduce(lambda a, b: a & b, [X.is_truthy(c, types[c]) for c in columns]))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")


def uniqueness(name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and surplus rows of a table, as one row."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("copies"))
    return per_key.agg(
        F.lit(name).alias("table_name"),
        F.coalesce(F.sum("copies"), F.lit(0)).alias("n_rows"),
        F.count("*").alias("n_keys"),
        F.count_if(F.col("copies") > 1).alias("repeated_keys"),
    )


def orphan_count(child: DataFrame, column: str, parent: DataFrame, parent_column: str, label: str) -> DataFrame:
    """Child rows whose key is set but absent from the parent.

    The child is counted per key first, so a hot key crosses the shuffle as one row.
    """
    per_key = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_k")).agg(F.count("*").alias("n"))
    known = parent.select(F.col(parent_column).alias("_k"))
    return per_key.join(known, "_k", "left_anti").agg(
        F.lit(label).alias("reference"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"),
        F.count("*").alias("orphan_keys"),
    )


def referential_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Orphans of every foreign key whose two tables are given."""
    parts = [
        orphan_count(tables[child], column, tables[parent], key, f"{child}.{column}")
        for child, column, parent, key in FOREIGN_KEYS
        if child in tables and parent in tables and column in tables[child].columns
    ]
    return reduce(DataFrame.unionByName, parts)


def null_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null and blank counts per column in one pass."""
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    cells = []
    for c in columns:
        blank = F.count_if(X.is_blank(c) & F.col(c).isNotNull()) if types[c] == "string" else F.lit(0)
        cells.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.count_if(F.col(c).isNull()).alias("nulls"),
                blank.cast("bigint").alias("blanks"),
            )
        )
    one_row = df.agg(F.count("*").alias("n_rows"), F.array(*cells).alias("cells"))
    return one_row.select("n_rows", F.inline("cells"))


def detail_coverage(products: DataFrame) -> DataFrame:
    """How many products have reviews, authors and specifications, and how many have either."""
    reviewed = F.coalesce(F.col("review_count") > 0, F.lit(False))
    return products.agg(
        F.count("*").alias("total_products"),
        F.count_if(reviewed).alias("with_reviews"),
        F.count("authors").alias("with_authors"),
        F.count("specifications").alias("with_specs"),
        F.count_if(reviewed | F.col("authors").isNotNull()).alias("with_detail"),
    )
