"""Upserts, inserts that ignore what exists, first-wins and duplicate removal.

Updates carry `seq`, their order inside a key (message offset or time, unique per key).
All folds are aggregations with map-side combine, so a key that repeats a billion times
reaches the shuffle as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from martlens.functions import scalars as X

POLICIES = ("present", "truthy", "given", "overwrite")


def _sets(updates: DataFrame, column: str, policy: str) -> Column:
    """Whether an update row sets the column."""
    if policy == "present":
        return F.array_contains("present", column)
    if policy == "truthy":
        return X.is_truthy(column, updates.schema[column].dataType)
    if policy == "given":
        return F.col(column).isNotNull()
    return F.lit(True)


def fold_updates(
    updates: DataFrame, key: str, columns: Sequence[str], policy: str = "present", seq: str = "seq"
) -> DataFrame:
    """One row per key: the last value set for each column and whether it was set at all.

    present    the key occurs in the message, even with a null value (`present` lists the keys)
    truthy     the value is not null, zero, '' or empty
    given      the value is not null
    overwrite  the last row wins in every column
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    aggs = []
    for c in columns:
        when_set = F.when(_sets(updates, c, policy), F.col(seq))
        aggs += [
            F.max_by(c, when_set).alias(c),
            F.max(when_set).isNotNull().alias(f"_set_{c}"),
        ]
    return updates.groupBy(key).agg(*aggs)


def merge_rows(
    current: DataFrame,
    updates: DataFrame,
    key: str,
    columns: Sequence[str],
    policy: str = "present",
    seq: str = "seq",
    as_of: Column | None = None,
    touched: str | None = None,
    created: str | None = None,
    defaults: dict[str, Column] | None = None,
    insert: bool = True,
    touch_always: bool = True,
) -> DataFrame:
    """Apply the folded updates to the current rows.

    `touched` is stamped with `as_of` on every updated row, or with touch_always=False only on
    rows whose values really change; `created` is stamped on new rows only.  Columns not in
    `columns` are protected.
    """
    defaults = defaults or {}
    new = fold_updates(updates, key, columns, policy, seq).withColumn("_new", F.lit(True))
    old = current.withColumn("_old", F.lit(True))
    folded = [c for f in columns for c in (f, f"_set_{f}")]
    new = new.select(key, "_new", *[F.col(c).alias(f"_n_{c}") for c in folded])
    joined = old.join(new, key, "full_outer" if insert else "left")

    was, arrives = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    is_set = lambda c: F.coalesce(F.col(f"_n__set_{c}"), F.lit(False))
    merged: dict[str, Column] = {key: F.col(key)}
    changes = []
    for c in current.columns:
        if c == key:
            continue
        if c in columns:
            fresh = F.col(f"_n_{c}").cast(current.schema[c].dataType)
            fallback = F.when(was, F.col(c)).otherwise(defaults.get(c, F.lit(None)))
            merged[c] = F.when(is_set(c), fresh).otherwise(fallback)
            changes.append(is_set(c) & ~fresh.eqNullSafe(F.col(c)))
        elif c in defaults:
            merged[c] = F.when(was, F.col(c)).otherwise(defaults[c])
        else:
            merged[c] = F.col(c)
    changed = reduce(lambda a, b: a | b, changes) if changes else F.lit(False)
    if touched:
        stamp = arrives if touch_always else (arrives & (~was | changed))
        merged[touched] = F.when(stamp, as_of).otherwise(F.col(touched))
    if created:
        merged[created] = F.when(was, F.col(created)).otherwise(as_of)
    return joined.select(*[merged[c].alias(c) for c in current.columns])


def upsert_products(products: DataFrame, messages: DataFrame, as_of: Column) -> DataFrame:
    """Listing messages into products: an absent key keeps the old value, a null replaces it."""
    columns = [
        c
        for c in (
            "name", "url", "image_url", "description", "rating", "sold_count", "shop_id", "category_id",
        )
        if c in products.columns and c in messages.columns
    ]
    return merge_rows(
        products,
        messages,
        "product_id",
        columns,
        policy="present",
        as_of=as_of,
        touched="last_updated" if "last_updated" in products.columns else None,
        created="first_seen" if "first_seen" in products.columns else None,
        defaults={"sold_count": F.lit(0)} if "sold_count" in products.columns else None,
    )


def enrich_products(products: DataFrame, details: DataFrame, as_of: Column) -> DataFrame:
    """Detail rows into products: only filled values replace, missing products are created."""
    skip = {"product_id", "first_seen", "last_updated"}
    columns = [c for c in products.columns if c in details.columns and c not in skip]
    return merge_rows(
        products,
        details,
        "product_id",
        columns,
        policy="given",
        as_of=as_of,
        touched="last_updated" if "last_updated" in products.columns else None,
        created="first_seen" if "first_seen" in products.columns else None,
    )


def overwrite_rows(
    current: DataFrame, items: DataFrame, key: str, protected: Sequence[str], as_of: Column, **stamps: str
) -> DataFrame:
    """Flat items into a table: every column the item has, except the key and the protected ones."""
    columns = [c for c in current.columns if c in items.columns and c not in {key, *protected}]
    policy = "present" if "present" in items.columns else "overwrite"
    return merge_rows(current, items, key, columns, policy=policy, as_of=as_of, **stamps)


PRICE_VALUES = ("price", "original_price", "discount_percent", "stock_available")


def price_rows(messages: DataFrame, at: str = "timestamp", seq: str = "seq") -> DataFrame:
    """Price rows of the messages whose price is set and not zero, the first per product and time."""
    priced = messages.filter(X.is_truthy("price", messages.schema["price"].dataType))
    return priced.groupBy("product_id", F.col(at).alias("timestamp")).agg(
        *[F.min_by(v, seq).alias(v) for v in PRICE_VALUES], F.min(seq).alias(seq)
    )


def append_prices(
    history: DataFrame, messages: DataFrame, at: str = "timestamp", seq: str = "seq"
) -> DataFrame:
    """History plus the new price rows; a price recorded for a product and time is never replaced."""
    key = ["product_id", "timestamp"]
    fresh = price_rows(messages, at, seq).join(history.select(*key), key, "left_anti")
    columns = [*key, *PRICE_VALUES]
    return history.select(*columns).unionByName(fresh.select(*columns))


def insert_ignore(current: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Add the rows whose key is not there yet; existing rows stay as they are."""
    fresh = rows.dropDuplicates([key]).join(current.select(key), key, "left_anti")
    return current.unionByName(fresh, allowMissingColumns=True)


def placeholders(ids: DataFrame, existing: DataFrame, key: str, label: str) -> DataFrame:
    """'<label> <id>' rows for the set, non-zero ids that have no row yet."""
    wanted = ids.filter(F.coalesce(F.col(key), F.lit(0)) != 0).select(key).distinct()
    missing = wanted.join(existing.select(key), key, "left_anti")
    return missing.select(key, F.concat(F.lit(f"{label} "), F.col(key)).alias("name"))


def ensure_shops(shops: DataFrame, messages: DataFrame) -> DataFrame:
    """Shops plus a placeholder for every new shop id."""
    new = placeholders(messages, shops, "shop_id", "Shop").select(
        "shop_id", F.col("name").alias("shop_name"), F.lit(False).alias("is_official")
    )
    return shops.unionByName(new, allowMissingColumns=True)


def upsert_shops(shops: DataFrame, details: DataFrame, seq: str = "seq") -> DataFrame:
    """Sellers of detail rows: the last given name wins, a new shop without one gets a placeholder."""
    sellers = details.filter(F.coalesce(F.col("shop_id"), F.lit(0)) != 0)
    return merge_rows(
        shops,
        sellers.select("shop_id", "shop_name", seq),
        "shop_id",
        ["shop_name"],
        policy="truthy",
        seq=seq,
        defaults={
            "shop_name": F.concat(F.lit("Shop "), F.col("shop_id")),
            "is_official": F.lit(False),
        },
    )


def ensure_categories(categories: DataFrame, messages: DataFrame) -> DataFrame:
    """Categories plus a placeholder for every new category id."""
    new = placeholders(messages, categories, "category_id", "Category").select(
        "category_id", F.col("name").alias("category_name")
    )
    return categories.unionByName(new, allowMissingColumns=True)


def first_wins(rows: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    """The earliest row of each key; rows with the same number are told apart by their other columns."""
    others = [c for c in rows.columns if c not in (key, seq)]
    first = rows.groupBy(key).agg(F.min(F.struct(seq, *others)).alias("_first"))
    return first.select(key, "_first.*").select(*rows.columns)


def new_rows(rows: DataFrame, existing: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    """First row of each key that is not stored yet: one review, one order, one sentiment."""
    fresh = rows.join(existing.select(key), key, "left_anti")
    return first_wins(fresh, key, seq)


def upsert_customers(customers: DataFrame, orders: DataFrame, as_of: Column, seq: str = "seq") -> DataFrame:
    """Customers with the last name seen; the row is stamped only when the name changes."""
    named = orders.filter(F.coalesce(F.col("customer_id"), F.lit(0)) != 0).select(
        "customer_id", F.coalesce("customer_name", F.lit("Anonymous")).alias("customer_name"), seq
    )
    return merge_rows(
        customers,
        named,
        "customer_id",
        ["customer_name"],
        policy="overwrite",
        seq=seq,
        as_of=as_of,
        touched="last_updated" if "last_updated" in customers.columns else None,
        created="created_at" if "created_at" in customers.columns else None,
        touch_always=False,
    )


def normal_text(c: Column | str) -> Column:
    """Text for comparison: lower case, white space collapsed, ends trimmed."""
    return F.trim(F.regexp_replace(F.lower(X.col(c)), f"{X.SPACE}+", " "))


def duplicate_groups(rows: DataFrame, key: str, text: str) -> DataFrame:
    """Groups of rows with the same normalised text: the id kept and the number of copies."""
    digest = F.sha2(normal_text(text), 256)
    return (
        rows.filter(F.col(text).isNotNull())
        .groupBy(digest.alias("digest"))
        .agg(F.min(key).alias("kept_id"), F.count("*").alias("copies"))
    )


def without_duplicates(rows: DataFrame, key: str, text: str) -> DataFrame:
    """Rows with the first of each group of equal texts; rows without text all stay."""
    kept = duplicate_groups(rows, key, text).select(F.col("kept_id").alias(key))
    with_text = rows.filter(F.col(text).isNotNull()).join(kept, key, "left_semi")
    return with_text.unionByName(rows.filter(F.col(text).isNull()))
