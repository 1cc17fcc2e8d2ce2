"""JSON payloads and messages made from the sample tables by Spark.

Missing keys, null values, bad types and cut-off texts are mixed in by id, so that every rule
of the parsers, contracts and merges has rows that meet it and rows that break it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martlens.plans.sample_model import SampleModel, n_rows

EXPLICIT_NULLS = {"ignoreNullFields": "false"}


def unless(test: Column, value: Column) -> Column:
    """Null where the test holds."""
    return F.when(~test, value)


def json_of(fields: dict[str, Column], explicit_nulls: Column) -> Column:
    """JSON text whose null fields are missing, or written as null where asked."""
    body = F.struct(*[c.alias(n) for n, c in fields.items()])
    return F.when(explicit_nulls, F.to_json(body, EXPLICIT_NULLS)).otherwise(F.to_json(body))


def listing_elements(m: SampleModel) -> DataFrame:
    k = F.col("p_partkey")
    shop = k % n_rows(m.raw("supplier"))
    path = F.when(k % 13 == 0, "1/2/books").otherwise(F.concat(F.lit("1/2/"), F.col("p_size")))
    fields = {
        "id": k,
        "name": unless(k % 11 == 0, F.concat(F.lit("  "), F.col("p_name"), F.lit(" \t"))),
        "url_path": unless(k % 5 == 0, F.concat(F.lit("p"), k, F.lit(".html"))),
        "thumbnail_url": unless(k % 3 == 0, F.concat(F.lit("img/"), k)),
        "short_description": F.col("p_brand"),
        "seller": unless(
            k % 4 == 0, F.struct(shop.alias("id"), F.concat(F.lit(" Shop "), shop, F.lit(" ")).alias("name"))
        ),
        "seller_id": unless(k % 8 == 0, shop),
        "primary_category_path": path,
        "rating_average": unless(k % 7 == 0, F.col("p_size") / 10),
        "quantity_sold": unless(k % 6 == 0, F.struct(F.col("p_size").alias("value"))),
        "price": F.col("p_retailprice"),
        "original_price": F.col("p_retailprice") + 100,
        "discount_rate": F.col("p_size"),
        "availability": k % 2,
        "visible_impression_info": F.struct(
            F.struct(
                F.when(k % 10 == 1, "OFFICIAL_STORE").otherwise("OTHER").alias("seller_type")
            ).alias("amplitude")
        ),
    }
    return m.parts.select(k, json_of(fields, k % 11 == 0).alias("element"))


def listing_pages(m: SampleModel) -> DataFrame:
    """Pages of ten elements; every page knows the last page's number."""
    per_page = 10
    page = F.floor(F.col("p_partkey") / per_page).cast("int") + 1
    pages = (
        listing_elements(m)
        .groupBy(page.alias("page"))
        .agg(F.array_sort(F.collect_list(F.struct("p_partkey", "element"))).alias("rows"))
    )
    total = n_rows(m.raw("part"))
    items = F.array_join(F.transform("rows", lambda r: r["element"]), ",")
    last = F.ceil(total / per_page).cast("int")
    body = F.concat(
        F.lit('{"data":['), items, F.lit('],"paging":{"total":'), total, F.lit(',"last_page":'), last, F.lit("}}")
    )
    return pages.select("page", body.alias("body"))


def catalog_elements(m: SampleModel) -> DataFrame:
    k = F.col("p_partkey")
    shop = k % n_rows(m.raw("supplier"))
    fields = {
        "id": k,
        "name": F.concat(F.lit(" "), F.col("p_name")),
        "url_path": unless(k % 5 == 0, F.concat(F.lit("p"), k)),
        "short_description": F.col("p_brand"),
        "seller": unless(
            k % 4 == 0,
            F.struct(shop.alias("id"), F.col("p_brand").alias("name"), (k % 3 == 0).alias("is_best_store")),
        ),
        "categories": unless(k % 6 == 0, F.struct(F.col("p_size").alias("id"))),
        "rating_average": F.col("p_size") / 10,
        "quantity_sold": F.struct(F.col("p_size").alias("value")),
        "price": F.col("p_retailprice"),
        "original_price": F.col("p_retailprice"),
        "discount_rate": F.col("p_size"),
        "stock_item": unless(k % 9 == 0, F.struct((k % 50).cast("int").alias("qty"))),
    }
    return m.parts.select(json_of(fields, k % 9 == 0).alias("element"))


def review_fields(m: SampleModel) -> dict[str, Column]:
    k = F.col("review_id")
    pictures = F.transform(F.sequence(F.lit(1), (k % 3).cast("int") + 1), lambda i: F.struct((k * 10 + i).alias("id")))
    return {
        "id": k,
        "title": F.concat(F.lit("Title "), k),
        "content": F.when(k % 4 == 0, "").otherwise(F.concat(F.lit(" text "), k, F.lit("\n"))),
        "thank_count": unless(k % 5 == 0, F.col("helpful_count")),
        "rating": F.col("rating"),
        "images": unless(~F.col("has_images"), pictures),
        # epoch seconds; every seventh review has none
        "created_at": unless(k % 7 == 0, F.unix_seconds(F.col("created_at"))),
        "created_by": F.struct(
            F.col("user_id").alias("id"),
            unless(k % 9 == 0, F.col("user_name")).alias("name"),
            F.when(k % 3 == 0, "").when(k % 3 == 1, F.concat(F.lit("Full "), F.col("user_name"))).alias("full_name"),
        ),
    }


def review_messages(m: SampleModel) -> DataFrame:
    """Full review messages; one in five is sent twice, and later copies have other stars."""
    k = F.col("review_id")
    fields = review_fields(m)
    copies = F.when(k % 5 == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    # reviews lie in few files, and their messages are many times larger
    sent = m.review_facts.repartition("review_id").withColumn("copy", F.explode(copies))
    stars = F.when(F.col("copy") == 1, F.col("rating") % 5 + 1).otherwise(F.col("rating"))
    body = F.to_json(
        F.struct(
            *[c.alias(n) for n, c in {**fields, "rating": stars, "product_id": F.col("product_id")}.items()]
        )
    )
    return sent.select(
        (k * 2 + F.col("copy")).alias("seq"), k.cast("string").alias("key"), body.alias("value")
    )


def flat_review_elements(m: SampleModel) -> DataFrame:
    """Review elements of a page; times are ISO text here."""
    k = F.col("review_id")
    iso = F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    fields = {
        **review_fields(m),
        "content": unless(k % 6 == 0, F.concat(F.lit("  text "), k, F.lit(" \n"))),
        "created_at": F.when(k % 8 == 0, "yesterday").when(k % 7 != 0, iso),
    }
    return m.review_facts.select(k, "product_id", json_of(fields, k % 6 == 0).alias("element"))


def detail_payloads(m: SampleModel) -> DataFrame:
    """Product detail payloads, with the raw HTML pages as descriptions."""
    k = F.col("p_partkey")
    shop = k % n_rows(m.raw("supplier"))
    pages = m.pages.select(F.col("page_id"), F.col("html"))
    n_pages = n_rows(m.raw("pages"))
    author = F.struct(F.lit(1).alias("id"), F.col("p_brand").alias("name"), F.lit("s").alias("slug"))
    fields = {
        "id": k,
        "name": F.when(k % 10 == 0, "").otherwise(F.concat(F.col("p_name"), F.lit(" full"))),
        "short_url": unless(k % 2 == 0, F.concat(F.lit("https://shop.example/s/"), k)),
        "url_path": unless(k % 4 == 0, F.concat(F.lit("d/"), k)),
        "short_description": unless(k % 5 == 0, F.col("p_brand")),
        "description": unless(k % 3 == 0, F.col("html")),
        "rating_average": F.when(k % 6 == 0, 0.0).otherwise(F.col("p_size") / 10),
        "review_count": (k % 4).cast("int"),
        "discount_rate": (k % 3).cast("int"),
        "all_time_quantity_sold": F.when(k % 4 == 1, 0).when(k % 4 != 2, F.col("p_size")),
        "quantity_sold": unless(k % 8 == 0, F.struct((F.col("p_size") + 1000).alias("value"))),
        "categories": unless(k % 7 == 0, F.struct((k % 9).cast("int").alias("id"))),
        "current_seller": F.struct(shop.alias("id"), unless(k % 3 != 1, F.col("p_brand")).alias("name")),
        "authors": F.when(k % 3 != 0, F.array(author)),
    }
    parts = m.parts.withColumn("page_id", k % n_pages)
    joined = parts.join(pages, "page_id")
    return joined.select(k.alias("seq"), json_of(fields, k % 2 == 0).alias("value"))


def product_messages(m: SampleModel, versions: int = 3) -> DataFrame:
    """Flat product messages: some versions per product, with missing and null keys."""
    k, v = F.col("p_partkey"), F.col("v")
    fields = {
        "item_type": F.lit("product"),
        "product_id": k,
        "name": F.concat(F.col("p_name"), F.lit(" v"), v),
        "url": F.concat(F.lit("https://shop.example/p"), k),
        "shop_id": F.when(v == 3, 0).otherwise(k % 50 + n_rows(m.raw("supplier")) - 5),
        "category_id": unless((k + v) % 5 == 0, (k % 12).cast("int")),
        "rating": unless((k + v) % 3 == 0, (F.col("p_size") % 5 + 0.5)),
        "sold_count": unless((k + v) % 4 == 0, F.col("p_size") * v),
        "description": unless(v == 2, F.concat(F.col("p_brand"), F.lit(" "), v)),
        "price": F.when((k + v) % 7 == 0, 0).when((k + v) % 6 != 0, (k % 100 + v * 10).cast("int")),
        "original_price": (k % 100 + 500).cast("int"),
        "discount_percent": (k % 30).cast("int"),
        "crawled_at": F.concat(F.lit("2024-01-0"), F.when(v == 3, 2).otherwise(v), F.lit("T00:00:00")),
    }
    # parts lie in few files; spread before their messages are made, and again as these are many times larger
    many = m.parts.repartition("p_partkey").withColumn("v", F.explode(F.sequence(F.lit(1), F.lit(versions))))
    made = many.select(
        (k * 10 + v).alias("seq"),
        k.cast("string").alias("key"),
        json_of(fields, (k + v) % 2 == 0).alias("value"),
    )
    return made.repartition("seq")


def order_messages(m: SampleModel) -> DataFrame:
    """Order messages of all reviews; some have no customer id."""
    k = F.col("review_id")
    return m.review_facts.select(
        k.alias("seq"),
        k,
        "product_id",
        unless(k % 11 == 0, F.col("user_id")).alias("customer_id"),
        F.when(k % 4 == 0, F.concat(F.lit("Full "), "user_name")).otherwise(F.col("user_name")).alias("customer_name"),
        F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("order_date"),
        "rating",
    )


def run_events(m: SampleModel) -> DataFrame:
    """Crawl run events: each user stands for one run."""
    kind = F.col("event_type")
    k = F.from_json("props", "k INT").getField("k")
    return m.raw("events").select(
        F.col("user_id").alias("run_id"),
        F.col("event_id").alias("seq"),
        F.when(kind == "signup", "start")
        .when(kind == "error", "error")
        .when(kind == "purchase", "close")
        .otherwise("page")
        .alias("kind"),
        F.col("ts").alias("at"),
        (k % 10).alias("items"),
        k.alias("page"),
        F.concat(F.lit("msg "), "event_id").alias("message"),
        F.when(k % 2 == 0, "finished").otherwise("shutdown").alias("reason"),
    )


def crawl_actions(m: SampleModel) -> DataFrame:
    """Queue actions on categories that exist and on some that do not."""
    k = F.col("event_id")
    names = F.array(*[F.lit(a) for a in ("activate", "deactivate", "reset", "status")])
    states = F.array(*[F.lit(x) for x in ("in_progress", "completed", "failed")])
    return m.raw("events").select(
        (k % 40).cast("int").alias("category_id"),
        k.alias("seq"),
        F.element_at(names, (k % 7 % 4 + 1).cast("int")).alias("action"),
        F.col("ts").alias("at"),
        F.element_at(states, (k % 3 + 1).cast("int")).alias("status"),
        F.when(k % 3 == 2, F.concat(F.lit("code "), k)).alias("message"),
    )
