"""Payload and message parsing: raw JSON text in, typed columns out.

Rows a payload parser cannot accept are not dropped: they carry the reasons in `problems`
and `accepted` / `rejected` split the two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martlens import schemas
from martlens.functions import scalars as X


def accepted(df: DataFrame) -> DataFrame:
    return df.filter(F.size("problems") == 0).drop("problems")


def rejected(df: DataFrame) -> DataFrame:
    return df.filter(F.size("problems") > 0)


def _problems(**tests: Column) -> Column:
    """Names of the tests that are true, as an array."""
    found = F.array(*[F.when(F.coalesce(t, F.lit(False)), F.lit(n)) for n, t in tests.items()])
    return F.array_compact(found).alias("problems")


def _read(df: DataFrame, raw: str, schema: str) -> DataFrame:
    """Parse JSON text once: its fields as `_d`, the keys it has as `_keys`."""
    both = F.struct(F.from_json(raw, schema).alias("d"), F.json_object_keys(raw).alias("keys"))
    return X.once(df, "_p", both).withColumns({"_d": F.col("_p.d"), "_keys": F.col("_p.keys")})


def _has_key(key: str) -> Column:
    return F.array_contains("_keys", key)


def _is_json_null(key: str, parsed: Column) -> Column:
    """The key is present but holds null (or a value of another type)."""
    return parsed.isNull() & _has_key(key)


def page_elements(pages: DataFrame, body: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per element of a page's `data`, with the page columns asked for.

    Elements stay JSON text; the page number and last page come along.
    """
    return X.once(pages.select(*keep, body), "_page", F.from_json(body, schemas.PAGE)).select(
        *keep,
        F.col("_page.paging.last_page").alias("last_page"),
        F.posexplode("_page.data").alias("position", "element"),
    )


def listing_products(
    elements: DataFrame, raw: str = "element", site: str = "https://shop.example/"
) -> DataFrame:
    """Listing elements to flat product items."""
    df = _read(elements, raw, schemas.LISTING_ITEM)
    get = lambda path: F.col(f"_d.{path}")
    has_path = X.blank_to_null(get("primary_category_path")).isNotNull()
    has_seller = get("seller.id").isNotNull() | get("seller.name").isNotNull()
    return df.select(
        F.lit("product").alias("item_type"),
        get("id").alias("product_id"),
        F.coalesce(X.strip(get("name")), F.lit("")).alias("name"),
        F.coalesce(F.concat(F.lit(site), X.blank_to_null(get("url_path"))), F.lit("")).alias("url"),
        F.when(_has_key("thumbnail_url"), get("thumbnail_url")).otherwise("").alias("image_url"),
        F.when(_has_key("short_description"), get("short_description"))
        .otherwise("")
        .alias("description"),
        F.when(has_seller, F.coalesce(get("seller.id"), F.lit(0)))
        .otherwise(F.coalesce(get("seller_id"), F.lit(0)))
        .alias("shop_id"),
        X.path_tail_int(get("primary_category_path")).alias("category_id"),
        F.coalesce(get("rating_average"), F.lit(0.0)).alias("rating"),
        F.coalesce(get("quantity_sold.value"), F.lit(0)).alias("sold_count"),
        F.coalesce(get("price"), F.lit(0.0)).alias("price"),
        F.coalesce(get("original_price"), F.lit(0.0)).alias("original_price"),
        F.coalesce(get("discount_rate"), F.lit(0)).alias("discount_percent"),
        F.when(get("availability") == 1, 1).otherwise(0).alias("stock_available"),
        _problems(
            name=_is_json_null("name", get("name")),
            rating_average=_is_json_null("rating_average", get("rating_average")),
            price=_is_json_null("price", get("price")),
            original_price=_is_json_null("original_price", get("original_price")),
            discount_rate=_is_json_null("discount_rate", get("discount_rate")),
            primary_category_path=has_path
            & X.path_tail_int(get("primary_category_path")).isNull(),
        ),
    )


def catalog_products(
    elements: DataFrame, raw: str = "element", site: str = "https://shop.example/"
) -> DataFrame:
    """The other product payload: category struct and stock quantity."""
    df = _read(elements, raw, schemas.CATALOG_ITEM)
    get = lambda path: F.col(f"_d.{path}")
    return df.select(
        F.lit("product").alias("item_type"),
        get("id").alias("product_id"),
        F.coalesce(X.strip(get("name")), F.lit("")).alias("name"),
        F.concat(F.lit(site), F.coalesce(get("url_path"), F.lit(""))).alias("url"),
        F.when(_has_key("thumbnail_url"), get("thumbnail_url")).otherwise("").alias("image_url"),
        F.when(_has_key("short_description"), get("short_description"))
        .otherwise("")
        .alias("description"),
        F.coalesce(get("seller.id"), F.lit(0)).alias("shop_id"),
        get("categories.id").alias("category_id"),
        F.coalesce(get("rating_average"), F.lit(0.0)).alias("rating"),
        F.coalesce(get("quantity_sold.value"), F.lit(0)).alias("sold_count"),
        F.coalesce(get("price"), F.lit(0.0)).alias("price"),
        F.coalesce(get("original_price"), F.lit(0.0)).alias("original_price"),
        F.coalesce(get("discount_rate"), F.lit(0)).alias("discount_percent"),
        F.coalesce(get("stock_item.qty"), F.lit(0)).alias("stock_available"),
        _problems(
            name=_is_json_null("name", get("name")),
            seller=_is_json_null("seller", get("seller")),
            stock_item=_is_json_null("stock_item", get("stock_item")),
            rating_average=_is_json_null("rating_average", get("rating_average")),
            price=_is_json_null("price", get("price")),
            original_price=_is_json_null("original_price", get("original_price")),
            discount_rate=_is_json_null("discount_rate", get("discount_rate")),
        ),
    )


def shop_items(
    elements: DataFrame, raw: str = "element", payload: str = "listing", keep: tuple[Column, ...] = ()
) -> DataFrame:
    """Seller of each element as a shop item; elements without a seller id give no row."""
    listing = payload == "listing"
    schema = schemas.LISTING_ITEM if listing else schemas.CATALOG_ITEM
    df = _read(elements, raw, schema)
    if listing:
        kind = F.col("_d.visible_impression_info.amplitude.seller_type")
        official = kind == "OFFICIAL_STORE"
    else:
        official = F.col("_d.seller.is_best_store")
    return df.filter(F.coalesce(F.col("_d.seller.id"), F.lit(0)) != 0).select(
        *keep,
        F.lit("shop").alias("item_type"),
        F.col("_d.seller.id").alias("shop_id"),
        F.coalesce(X.strip("_d.seller.name"), F.lit("")).alias("shop_name"),
        F.coalesce(official, F.lit(False)).alias("is_official"),
    )


def flat_reviews(
    elements: DataFrame, now: Column, parent: str = "product_id", raw: str = "element"
) -> DataFrame:
    """Review elements to flat review items; the product id is the page's."""
    df = _read(elements, raw, schemas.REVIEW_DETAIL)
    get = lambda path: F.col(f"_d.{path}")
    return df.select(
        F.lit("review").alias("item_type"),
        F.col(parent),
        F.coalesce(get("created_by.name"), F.lit("Anonymous")).alias("user_name"),
        F.coalesce(get("rating"), F.lit(0)).alias("rating"),
        F.coalesce(X.strip(get("content")), F.lit("")).alias("comment"),
        (F.coalesce(F.size(get("images")), F.lit(0)) > 0).alias("has_images"),
        F.coalesce(get("thank_count"), F.lit(0)).alias("helpful_count"),
        F.coalesce(get("created_at").try_cast("timestamp"), now).alias("created_at"),
        _problems(
            content=_is_json_null("content", get("content")),
            rating=_is_json_null("rating", get("rating")),
            images=_is_json_null("images", get("images")),
            thank_count=_is_json_null("thank_count", get("thank_count")),
        ),
    )


def review_details(messages: DataFrame, now: Column, body: str = "value", unreadable: str | None = None) -> DataFrame:
    """Full review messages to review rows plus the reviewer's id and the message order.

    `unreadable` names a column that says whether a message is anything but a JSON object.
    """
    extra = [c for c in messages.columns if c != body]
    df = _read(messages, body, schemas.REVIEW_DETAIL)
    if unreadable is not None:
        df = df.withColumn(unreadable, F.col("_keys").isNull())
        extra.append(unreadable)
    get = lambda path: F.col(f"_d.{path}")
    full_name = X.blank_to_null(get("created_by.full_name"))
    return df.select(
        *extra,
        get("id").alias("review_id"),
        get("product_id").alias("product_id"),
        F.coalesce(full_name, get("created_by.name"), F.lit("Anonymous")).alias("user_name"),
        F.coalesce(get("rating"), F.lit(0)).alias("rating"),
        F.coalesce(X.blank_to_null(get("content")), get("title"), F.lit("")).alias("comment"),
        (F.coalesce(F.size(get("images")), F.lit(0)) > 0).alias("has_images"),
        F.coalesce(get("thank_count"), F.lit(0)).alias("helpful_count"),
        X.moment(get("created_at"), now).alias("created_at"),
        get("created_by.id").alias("customer_id"),
    )


def product_details(
    payloads: DataFrame, body: str = "value", site: str = "https://shop.example/"
) -> DataFrame:
    """Detail payloads to the product columns they may enrich.  Nested parts become JSON text."""
    extra = [c for c in payloads.columns if c != body]
    df = _read(payloads, body, schemas.PRODUCT_DETAIL)
    get = lambda path: F.col(f"_d.{path}")
    some = X.blank_to_null
    filled = lambda c: F.when(F.size(get(c)) > 0, F.to_json(get(c))).alias(c)
    html = some(get("description"))
    return df.select(
        *extra,
        get("id").alias("product_id"),
        some(get("name")).alias("name"),
        F.coalesce(some(get("short_url")), F.concat(F.lit(site), some(get("url_path")))).alias("url"),
        some(get("thumbnail_url")).alias("image_url"),
        F.when(html.isNotNull(), X.strip_html(html))
        .otherwise(some(get("short_description")))
        .alias("description"),
        F.nullif(get("rating_average"), F.lit(0.0)).try_cast("decimal(3,2)").alias("rating"),
        F.coalesce(
            F.nullif(get("all_time_quantity_sold"), F.lit(0)),
            F.nullif(get("quantity_sold.value"), F.lit(0)),
        ).alias("sold_count"),
        F.nullif(get("categories.id"), F.lit(0)).alias("category_id"),
        F.nullif(get("current_seller.id"), F.lit(0)).alias("shop_id"),
        some(get("current_seller.name")).alias("shop_name"),
        F.nullif(get("review_count"), F.lit(0)).alias("review_count"),
        F.nullif(get("discount_rate"), F.lit(0)).alias("discount_rate"),
        some(get("short_description")).alias("short_description"),
        filled("authors"),
        filled("specifications"),
        filled("configurable_options"),
    )


def star_histogram(payloads: DataFrame, body: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """The stars map of a review page as one row per star."""
    return payloads.select(
        *keep, F.explode(F.from_json(body, schemas.REVIEW_STARS).getField("stars"))
    ).select(
        *keep,
        F.col("key").cast("int").alias("stars"),
        F.col("value.count").alias("n"),
        F.col("value.percent").alias("percent"),
    )


def order_messages(reviews: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The order message of each accepted review."""
    return reviews.select(
        *keep,
        "review_id",
        "product_id",
        "customer_id",
        F.col("user_name").alias("customer_name"),
        X.iso_text("created_at").alias("order_date"),
        "rating",
    )


def sentiment_messages(reviews: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The scoring message of each review; a null comment becomes ''."""
    return reviews.select(
        *keep,
        "review_id",
        "product_id",
        F.coalesce("comment", F.lit("")).alias("comment"),
        "rating",
        X.iso_text("created_at").alias("created_at"),
    )


def detail_requests(products: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Detail requests; a missing or zero spid falls back to the product id."""
    spid = F.nullif("spid", F.lit(0)) if "spid" in products.columns else F.lit(None).cast("bigint")
    return products.select(*keep, "product_id", F.coalesce(spid, "product_id").alias("spid"))


def review_requests(details: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Review requests; an unknown seller becomes 1."""
    return details.select(
        *keep,
        "product_id",
        F.coalesce("spid", "product_id").alias("spid"),
        F.coalesce(F.nullif("seller_id", F.lit(0)), F.lit(1)).alias("seller_id"),
    )
