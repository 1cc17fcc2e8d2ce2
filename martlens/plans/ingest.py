"""Registered queries: sources, parsing, contracts, merges, derived facts, scoring, bookkeeping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from martlens import schemas
from martlens.functions import scalars as X
from martlens.functions.ordered import as_of_join
from martlens.operators import crawl as C, derive as D, merge as U, parse, quality as V, sentiment as M, similarity as near
from martlens.plans import sample_messages as S
from martlens.plans.oracle import PRICE_NOW, REVIEW_NOW, dbl, ts
from martlens.plans.registry import query
from martlens.plans.sample_model import SITE, SampleModel
from martlens.session import work_dir
from martlens.sources import files, messages
from martlens.sources.tables import LogTable

SPACE = X.SPACE
N_SHOPS = "(SELECT count(*) FROM supplier)"

# sources and sinks -------------------------------------------------------------------------


def _raw_messages(m: SampleModel) -> DataFrame:
    k = F.col("review_id")
    body = F.to_json(F.struct("review_id", "product_id", "rating"))
    text = F.when(k % 17 == 0, F.left(body, F.lit(15))).when(k % 19 == 0, "[1,2]").otherwise(body)
    return m.review_facts.select(k.alias("seq"), text.alias("value"))


@query("S1 F17", "SELECT review_id AS seq, review_id, product_id, rating FROM m_facts WHERE review_id % 17 <> 0 AND review_id % 19 <> 0")
def decoded_messages(m: SampleModel):
    read = messages.json_messages(_raw_messages(m), "review_id BIGINT, product_id BIGINT, rating INT")
    return messages.decoded(read).drop("present")


@query(
    "S1 T9",
    """
SELECT left('{"review_id":' || review_id || ',"product_id":', 15) AS value, 'not a JSON object' AS reason
FROM m_facts WHERE review_id % 17 = 0
UNION ALL SELECT '[1,2]', 'not a JSON object' FROM m_facts WHERE review_id % 17 <> 0 AND review_id % 19 = 0""",
)
def undecodable_messages(m: SampleModel):
    return messages.corrupt(messages.json_messages(_raw_messages(m), "review_id BIGINT, product_id BIGINT, rating INT"))


ORDER_JSON = """
SELECT CAST(review_id AS VARCHAR) AS key, CAST(to_json({'review_id': review_id, 'product_id': product_id,
  'customer_id': user_id, 'customer_name': user_name,
  'order_date': strftime(created_at, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(created_at) % 1000000 = 0 THEN ''
    ELSE strftime(created_at, '.%f') END, 'rating': rating}) AS VARCHAR) AS value
FROM m_facts"""


@query("S2 P11 F8", ORDER_JSON)
def order_message_sink(m: SampleModel):
    reviews = m.review_facts.withColumn("customer_id", F.col("user_id"))
    return messages.keyed(parse.order_messages(reviews), "review_id")


def _items(m: SampleModel) -> DataFrame:
    kinds = F.when(F.col("p_partkey") % 10 == 0, "banner").otherwise("product")
    products = m.raw("part").select(kinds.alias("item_type"), F.col("p_partkey").alias("product_id"), F.lit(None).cast("bigint").alias("shop_id"))
    reviews = m.review_facts.select(F.lit("review").alias("item_type"), "product_id", F.lit(None).cast("bigint").alias("shop_id"))
    shops = m.shops.select(F.lit("shop").alias("item_type"), F.lit(None).cast("bigint").alias("product_id"), "shop_id")
    return products.unionByName(reviews).unionByName(shops)


@query(
    "S3",
    """
SELECT 'products' AS topic, CAST(p_partkey AS VARCHAR) AS key, count(*) AS n FROM part WHERE p_partkey % 10 <> 0 GROUP BY 2
UNION ALL SELECT 'reviews', CAST(product_id AS VARCHAR), count(*) FROM m_facts GROUP BY 2
UNION ALL SELECT 'shops', CAST(s_suppkey AS VARCHAR), count(*) FROM supplier GROUP BY 2""",
)
def topic_routing(m: SampleModel):
    return messages.routed(_items(m)).groupBy("topic", "key").agg(F.count("*").alias("n"))


EXPORT_SQL = f"SELECT product_id, name, {dbl('rating')}, sold_count, {ts('first_seen')}, authors FROM m_products"
EXPORT_SCHEMA = "product_id BIGINT, name STRING, rating DECIMAL(3,2), sold_count INT, first_seen TIMESTAMP, authors STRING"


def _export(m: SampleModel) -> DataFrame:
    return m.products.select("product_id", "name", "rating", "sold_count", "first_seen", "authors")


@query("S4 S5", EXPORT_SQL)
def json_lines_round_trip(m: SampleModel):
    path = work_dir(m.spark, "json-lines")
    files.write_json_lines(_export(m), path)
    return files.read_json_lines(m.spark, path, EXPORT_SCHEMA)


@query("S5", EXPORT_SQL)
def csv_round_trip(m: SampleModel):
    path = work_dir(m.spark, "csv")
    files.write_csv(_export(m), path)
    return files.read_csv(m.spark, path, EXPORT_SCHEMA)


@query("S5", "SELECT doc_id, text FROM documents")
def csv_text_round_trip(m: SampleModel):
    path = work_dir(m.spark, "csv-text")
    files.write_csv(m.documents.select("doc_id", "text"), path)
    return files.read_csv(m.spark, path, "doc_id BIGINT, text STRING")


@query("S6", "SELECT product_id, name, authors, specifications FROM m_products")
def product_json_fields(m: SampleModel):
    return m.products.select("product_id", "name", "authors", "specifications")


@query("S6 P14", "SELECT p_partkey AS product_id, p_name AS name, left(p_brand, 7) AS short_desc FROM part WHERE p_size >= 10")
def product_scan(m: SampleModel):
    parts = m.raw("part").filter("p_size >= 10")
    return parts.select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"), X.preview("p_brand", 7).alias("short_desc")
    )


@query("S7 T6", "SELECT review_id, product_id, rating FROM m_facts")
def replayed_table_sink(m: SampleModel):
    rows = m.review_facts.select("review_id", "product_id", "rating")
    table = LogTable(m.spark, work_dir(m.spark, "sink") + "/reviews", "review_id BIGINT, product_id BIGINT, rating INT").create()
    for batch_id in (0, 1, 1):  # batch 1 is written again, as after a crash
        table.append(rows.filter(F.col("review_id") % 2 == batch_id), "reviews", batch_id)
    return table.current()


@query(
    "S8 O9",
    """
WITH landed AS (SELECT DISTINCT user_id, CAST(event_id % 9 + 1 AS INTEGER) AS page FROM events),
ends AS (SELECT user_id, CASE WHEN bool_or(page = 1) THEN 9 + user_id % 3 ELSE 1 END AS last_page FROM landed GROUP BY user_id)
SELECT user_id, CAST(page AS INTEGER) AS page FROM (SELECT user_id, unnest(range(1, last_page + 1)) AS page FROM ends)
WHERE (user_id, page) NOT IN (SELECT user_id, page FROM landed)""",
)
def missing_review_pages(m: SampleModel):
    page = (F.col("event_id") % 9 + 1).cast("int").alias("page")
    landed = m.raw("events").select("user_id", page, (F.col("user_id") % 3 + 9).cast("int").alias("last_page")).distinct()
    return C.missing_pages(landed, "user_id")


# parsing -----------------------------------------------------------------------------------


@query(
    "P1",
    """
SELECT CAST(p_partkey // 10 + 1 AS INTEGER) AS page, CAST(p_partkey % 10 AS INTEGER) AS position, p_partkey AS product_id,
       CAST(ceil((SELECT count(*) FROM part) / 10.0) AS INTEGER) AS last_page FROM part""",
)
def page_elements(m: SampleModel):
    found = parse.page_elements(S.listing_pages(m), "body", ("page",))
    key = F.get_json_object("element", "$.id").cast("bigint")
    return found.select("page", "position", key.alias("product_id"), "last_page")


LISTING_SQL = f"""
SELECT 'product' AS item_type, p_partkey AS product_id, p_name AS name,
       CASE WHEN p_partkey % 5 = 0 THEN '' ELSE '{SITE}p' || p_partkey || '.html' END AS url,
       CASE WHEN p_partkey % 3 = 0 THEN '' ELSE 'img/' || p_partkey END AS image_url, p_brand AS description,
       CASE WHEN p_partkey % 8 = 0 THEN 0 ELSE p_partkey % {N_SHOPS} END AS shop_id, p_size AS category_id,
       CASE WHEN p_partkey % 7 = 0 THEN 0.0 ELSE p_size / 10.0 END AS rating,
       CASE WHEN p_partkey % 6 = 0 THEN 0 ELSE p_size END AS sold_count, p_retailprice AS price,
       p_retailprice + 100 AS original_price, p_size AS discount_percent, CAST(p_partkey % 2 AS INTEGER) AS stock_available
FROM part WHERE p_partkey % 11 <> 0 AND p_partkey % 13 <> 0"""


@query("P1 P2 P3 F18", LISTING_SQL)
def listing_products(m: SampleModel):
    elements = parse.page_elements(S.listing_pages(m), "body")
    return parse.accepted(parse.listing_products(elements, site=SITE))


@query(
    "P2 Q4",
    """
SELECT p_partkey AS product_id, '["' || concat_ws('","', CASE WHEN p_partkey % 11 = 0 THEN 'name' END,
  CASE WHEN p_partkey % 77 = 0 THEN 'rating_average' END,
  CASE WHEN p_partkey % 13 = 0 THEN 'primary_category_path' END) || '"]' AS problems
FROM part WHERE p_partkey % 11 = 0 OR p_partkey % 13 = 0""",
)
def refused_listing_products(m: SampleModel):
    return parse.rejected(parse.listing_products(S.listing_elements(m))).select("product_id", "problems")


@query("P3", "SELECT p_partkey, CASE WHEN p_partkey % 13 <> 0 THEN p_size END AS category_id FROM part")
def category_from_path(m: SampleModel):
    path = F.get_json_object("element", "$.primary_category_path")
    return S.listing_elements(m).select("p_partkey", X.path_tail_int(path).alias("category_id"))


# rows with k % 9 = 0 hold explicit nulls for seller or stock and are refused
@query(
    "P4",
    f"""
SELECT 'product' AS item_type, p_partkey AS product_id, p_name AS name,
       '{SITE}' || CASE WHEN p_partkey % 5 = 0 THEN '' ELSE 'p' || p_partkey END AS url, '' AS image_url,
       p_brand AS description, CASE WHEN p_partkey % 4 = 0 THEN 0 ELSE p_partkey % {N_SHOPS} END AS shop_id,
       CASE WHEN p_partkey % 6 <> 0 THEN p_size END AS category_id, p_size / 10.0 AS rating, p_size AS sold_count,
       p_retailprice AS price, p_retailprice AS original_price, p_size AS discount_percent,
       CAST(p_partkey % 50 AS INTEGER) AS stock_available
FROM part WHERE p_partkey % 9 <> 0""",
)
def catalog_products(m: SampleModel):
    return parse.accepted(parse.catalog_products(S.catalog_elements(m), site=SITE))


@query(
    "P5",
    f"""
SELECT 'shop' AS item_type, p_partkey % {N_SHOPS} AS shop_id, 'Shop ' || (p_partkey % {N_SHOPS}) AS shop_name,
       p_partkey % 10 = 1 AS is_official
FROM part WHERE p_partkey % 4 <> 0 AND p_partkey % {N_SHOPS} <> 0""",
)
def listing_shops(m: SampleModel):
    return parse.shop_items(S.listing_elements(m))


@query(
    "P4 V9",
    """
SELECT p_partkey AS product_id, p_name AS name FROM part WHERE p_partkey % 9 = 0""",
)
def refused_catalog_products(m: SampleModel):
    return parse.rejected(parse.catalog_products(S.catalog_elements(m), site=SITE)).select("product_id", "name")


@query(
    "U10",
    f"""
SELECT product_id, CASE WHEN item THEN p_name ELSE name END AS name,
       CASE WHEN item THEN '{SITE}' || CASE WHEN p_partkey % 5 = 0 THEN '' ELSE 'p' || p_partkey END ELSE url END AS url,
       CASE WHEN item THEN p_size ELSE sold_count END AS sold_count, review_count
FROM (SELECT *, p_partkey % 9 <> 0 AS item FROM part) JOIN (SELECT product_id, name, url, sold_count, review_count FROM m_products)
  ON product_id = p_partkey""",
)
def product_overwrite(m: SampleModel):
    stored = m.products.select("product_id", "name", "url", "sold_count", "review_count")
    items = parse.accepted(parse.catalog_products(S.catalog_elements(m), site=SITE))
    numbered = items.withColumn("seq", F.col("product_id"))
    return U.overwrite_rows(stored, numbered, "product_id", ["review_count"], m.review_time)


@query(
    "P5 Q14",
    f"""
SELECT 'shop' AS item_type, p_partkey % {N_SHOPS} AS shop_id, p_brand AS shop_name, p_partkey % 3 = 0 AS is_official
FROM part WHERE p_partkey % 4 <> 0 AND p_partkey % {N_SHOPS} <> 0""",
)
def catalog_shops(m: SampleModel):
    return parse.shop_items(S.catalog_elements(m), payload="catalog")


@query(
    "P6",
    f"""
SELECT 'review' AS item_type, product_id, CASE WHEN review_id % 9 = 0 THEN 'Anonymous' ELSE user_name END AS user_name,
       rating, 'text ' || review_id AS comment, has_images,
       CASE WHEN review_id % 5 = 0 THEN 0 ELSE helpful_count END AS helpful_count,
       strftime(CASE WHEN review_id % 8 = 0 OR review_id % 7 = 0 THEN {REVIEW_NOW}
         ELSE date_trunc('second', created_at) END, '%Y-%m-%d %H:%M:%S.%f') AS created_at
FROM m_facts WHERE review_id % 6 <> 0""",
)
def flat_reviews(m: SampleModel):
    return parse.accepted(parse.flat_reviews(S.flat_review_elements(m), m.review_time))


@query("P6", "SELECT product_id, rating FROM m_facts WHERE review_id % 6 = 0")
def refused_flat_reviews(m: SampleModel):
    return parse.rejected(parse.flat_reviews(S.flat_review_elements(m), m.review_time)).select("product_id", "rating")


REVIEW_DETAIL_SQL = f"""
SELECT review_id * 2 + copy AS seq, review_id, product_id,
       CASE WHEN review_id % 3 = 1 THEN 'Full ' || user_name WHEN review_id % 9 = 0 THEN 'Anonymous' ELSE user_name END AS user_name,
       CASE WHEN copy = 1 THEN rating % 5 + 1 ELSE rating END AS rating,
       CASE WHEN review_id % 4 = 0 THEN 'Title ' || review_id ELSE ' text ' || review_id || chr(10) END AS comment,
       has_images, CASE WHEN review_id % 5 = 0 THEN 0 ELSE helpful_count END AS helpful_count,
       CASE WHEN review_id % 7 = 0 THEN {REVIEW_NOW} ELSE date_trunc('second', m_facts.created_at) END AS created_at,
       user_id AS customer_id
FROM m_facts, (VALUES (0), (1)) c(copy) WHERE copy = 0 OR review_id % 5 = 1"""


@query("P7 F7 F18", f"SELECT * REPLACE (strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') AS created_at) FROM ({REVIEW_DETAIL_SQL})")
def review_details(m: SampleModel):
    return parse.review_details(S.review_messages(m).select("seq", "value"), m.review_time)


CLEAN = f"trim(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '{SPACE}+', ' ', 'g'))"
DETAIL_SQL = f"""
SELECT p_partkey AS product_id, CASE WHEN p_partkey % 10 <> 0 THEN p_name || ' full' END AS name,
       CASE WHEN p_partkey % 2 = 1 THEN '{SITE}s/' || p_partkey WHEN p_partkey % 4 <> 0 THEN '{SITE}d/' || p_partkey END AS url,
       CAST(NULL AS VARCHAR) AS image_url,
       CASE WHEN p_partkey % 3 <> 0 THEN {CLEAN} WHEN p_partkey % 5 <> 0 THEN p_brand END AS description,
       CASE WHEN p_partkey % 6 <> 0 AND p_size > 0 THEN p_size / 10.0 END AS rating,
       CASE WHEN p_partkey % 4 IN (0, 3) THEN p_size WHEN p_partkey % 8 <> 0 THEN p_size + 1000 END AS sold_count,
       CASE WHEN p_partkey % 7 <> 0 AND p_partkey % 9 <> 0 THEN CAST(p_partkey % 9 AS INTEGER) END AS category_id,
       nullif(p_partkey % {N_SHOPS}, 0) AS shop_id, CASE WHEN p_partkey % 3 = 1 THEN p_brand END AS shop_name,
       CAST(nullif(p_partkey % 4, 0) AS INTEGER) AS review_count, CAST(nullif(p_partkey % 3, 0) AS INTEGER) AS discount_rate,
       CASE WHEN p_partkey % 5 <> 0 THEN p_brand END AS short_description,
       CASE WHEN p_partkey % 3 <> 0 THEN '[{{"id":1,"name":"' || p_brand || '","slug":"s"}}]' END AS authors,
       CAST(NULL AS VARCHAR) AS specifications, CAST(NULL AS VARCHAR) AS configurable_options
FROM part JOIN pages ON page_id = p_partkey % (SELECT count(*) FROM pages)"""


@query("P8 P9 P10 F15", DETAIL_SQL)
def product_details(m: SampleModel):
    return parse.product_details(S.detail_payloads(m), site=SITE).drop("seq")


@query("P9 F15", f"SELECT page_id, {CLEAN} AS text FROM pages")
def clean_html(m: SampleModel):
    return m.pages.select("page_id", X.strip_html("html").alias("text"))


@query(
    "P10",
    """
SELECT p_partkey AS product_id, '[{"name":"' || p_brand || '","attributes":[{"code":"size","value":"' || p_size || '"}]}]' AS specifications
FROM part""",
)
def nested_json_text(m: SampleModel):
    attribute = F.struct(F.lit("size").alias("code"), F.col("p_size").cast("string").alias("value"))
    spec = F.struct(F.col("p_brand").alias("name"), F.array(attribute).alias("attributes"))
    return m.raw("part").select(F.col("p_partkey").alias("product_id"), F.to_json(F.array(spec)).alias("specifications"))


@query(
    "P12",
    """
SELECT review_id, product_id, CASE WHEN review_id % 3 = 0 THEN '' ELSE comment END AS comment, rating,
       strftime(created_at, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(created_at) % 1000000 = 0 THEN ''
         ELSE strftime(created_at, '.%f') END AS created_at
FROM m_reviews""",
)
def sentiment_messages(m: SampleModel):
    some_null = S.unless(F.col("review_id") % 3 == 0, F.col("comment"))
    return parse.sentiment_messages(m.reviews.withColumn("comment", some_null))


@query(
    "P13",
    """
SELECT p_partkey AS product_id, CASE WHEN p_partkey % 3 = 0 OR p_size = 0 THEN p_partkey ELSE p_size END AS spid,
       CASE WHEN p_partkey % 5 < 2 THEN 1 ELSE p_partkey % 5 END AS seller_id FROM part""",
)
def fetch_requests(m: SampleModel):
    k = F.col("p_partkey")
    found = m.raw("part").select(
        k.alias("product_id"), S.unless(k % 3 == 0, F.col("p_size").cast("bigint")).alias("spid"), (k % 5).alias("seller_id")
    )
    details = parse.detail_requests(found).join(found.select("product_id", "seller_id"), "product_id")
    return parse.review_requests(details)


@query(
    "F7 F14 F16 F17 F18 F19 F20 F13",
    """
SELECT review_id, strftime(date_trunc('second', created_at), '%Y-%m-%d %H:%M:%S.%f') AS from_epoch,
       strftime(date_trunc('second', created_at), '%Y-%m-%d %H:%M:%S.%f') AS from_iso,
       strftime(TIMESTAMP '2000-01-01', '%Y-%m-%d %H:%M:%S.%f') AS from_nothing,
       CASE WHEN review_id % 3 <> 0 THEN helpful_count END AS page, review_id + product_id AS id_total,
       coalesce(CASE WHEN review_id % 4 <> 0 THEN rating END, 0) AS rating_or_zero,
       CAST(('0x' || substr(md5(user_name), 1, 8)) AS BIGINT) % 1000000000 AS name_id
FROM m_facts""",
)
def parsing_functions(m: SampleModel):
    k = F.col("review_id")
    fallback = F.lit("2000-01-01").cast("timestamp")
    epoch = F.unix_seconds("created_at").cast("string")
    iso = F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    note = F.when(k % 3 == 0, "no page yet").otherwise(F.concat(F.lit("Last page: "), F.col("helpful_count"), F.lit(" done")))
    ids = X.id_list(F.concat_ws(" , ", k.cast("string"), F.col("product_id").cast("string")))
    body = F.to_json(F.struct(S.unless(k % 4 == 0, F.col("rating")).alias("rating")))
    return m.review_facts.select(
        k,
        X.moment(epoch, fallback).alias("from_epoch"),
        X.moment(iso, fallback).alias("from_iso"),
        X.moment(F.concat(F.lit("on "), iso), fallback).alias("from_nothing"),
        X.page_from_note(note).alias("page"),
        F.aggregate(ids, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("id_total"),
        F.coalesce(F.variant_get(F.parse_json(body), "$.rating", "int"), F.lit(0)).alias("rating_or_zero"),
        X.name_id("user_name").alias("name_id"),
    )


@query(
    "F19",
    """
SELECT product_id, rating AS stars, CAST(count(*) AS INTEGER) AS n, CAST(NULL AS INTEGER) AS percent FROM m_facts GROUP BY 1, 2""",
)
def star_histogram(m: SampleModel):
    per_star = m.review_facts.groupBy("product_id", "rating").agg(F.count("*").alias("n"))
    entry = F.struct(F.col("rating").cast("string").alias("key"), F.struct(F.col("n").alias("count")).alias("value"))
    # at most five entries per product
    page = per_star.groupBy("product_id").agg(F.map_from_entries(F.collect_list(entry)).alias("stars"))
    bodies = page.select("product_id", F.to_json(F.struct("stars")).alias("value"))
    return parse.star_histogram(bodies, keep=("product_id",))


# contracts ---------------------------------------------------------------------------------


def _dirty_products(m: SampleModel) -> DataFrame:
    k = F.col("product_id")
    return m.products.select(
        S.unless(k % 31 == 0, k).alias("product_id"),
        F.when(k % 9 == 1, "").when(k % 9 != 0, F.col("name")).alias("name"),
        S.unless(k % 8 == 0, F.col("shop_id")).alias("shop_id"),
        S.unless(k % 6 == 0, F.col("url")).alias("url"),
        (F.col("rating") + F.when(k % 5 == 0, 3).otherwise(0)).alias("rating"),
        F.when(k % 7 == 0, -1).otherwise(F.col("sold_count")).alias("sold_count"),
    )


DIRTY_PRODUCTS = """
SELECT CASE WHEN product_id % 31 <> 0 THEN product_id END AS product_id,
       CASE WHEN product_id % 9 = 1 THEN '' WHEN product_id % 9 <> 0 THEN name END AS name,
       CASE WHEN product_id % 8 <> 0 THEN shop_id END AS shop_id, CASE WHEN product_id % 6 <> 0 THEN url END AS url,
       rating + CASE WHEN product_id % 5 = 0 THEN 3 ELSE 0 END AS rating,
       CASE WHEN product_id % 7 = 0 THEN -1 ELSE sold_count END AS sold_count FROM m_products"""

# rule -> SQL that is true for a row that breaks it
PRODUCT_BREAKS = {
    "product_id_required": "product_id IS NULL",
    "shop_id_required": "shop_id IS NULL",
    "url_required": "url IS NULL",
    "name_length": "coalesce(length(name), 0) NOT BETWEEN 1 AND 1000",
    "rating_range": "rating < 0 OR rating > 5",
    "sold_count_min": "sold_count < 0",
}


def breaks_sql(source: str, breaks: dict[str, str]) -> str:
    parts = [
        f"SELECT '{rule}' AS rule, count(*) AS checked, count(CASE WHEN {test} THEN 1 END) AS violations FROM dirty"
        for rule, test in breaks.items()
    ]
    return f"WITH dirty AS ({source}) " + " UNION ALL ".join(parts)


@query("V1", breaks_sql(DIRTY_PRODUCTS, PRODUCT_BREAKS))
def product_contract(m: SampleModel):
    return V.violation_counts(_dirty_products(m), V.PRODUCT)


ANY_BREAK = " OR ".join(f"({t})" for t in PRODUCT_BREAKS.values())


@query("V1", f"SELECT * FROM ({DIRTY_PRODUCTS}) WHERE NOT coalesce({ANY_BREAK}, false)")
def valid_products(m: SampleModel):
    return V.valid_rows(_dirty_products(m), V.PRODUCT)


REASONS = ", ".join(f"CASE WHEN {t} THEN '{r}' END" for r, t in PRODUCT_BREAKS.items())


@query(
    "V1 Q5",
    f"SELECT product_id, concat_ws(',', {REASONS}) AS reason FROM ({DIRTY_PRODUCTS}) WHERE coalesce({ANY_BREAK}, false)",
)
def rejected_products(m: SampleModel):
    return V.reject_rows(_dirty_products(m), V.PRODUCT).select("product_id", "reason")


@query(
    "V2",
    breaks_sql(
        """
SELECT CASE WHEN review_id % 10 <> 0 THEN product_id END AS product_id,
       CASE WHEN review_id % 9 <> 0 THEN rating + CASE WHEN review_id % 4 = 0 THEN 2 ELSE 0 END END AS rating,
       CASE WHEN review_id % 6 <> 0 THEN created_at END AS created_at,
       CASE WHEN review_id % 5 = 0 THEN repeat(user_name, 50) ELSE user_name END AS user_name,
       CASE WHEN review_id % 8 = 0 THEN -1 ELSE helpful_count END AS helpful_count FROM m_facts""",
        {
            "product_id_required": "product_id IS NULL",
            "rating_range": "rating IS NULL OR rating NOT BETWEEN 1 AND 5",
            "created_at_required": "created_at IS NULL",
            "user_name_length": "length(user_name) > 255",
            "helpful_count_min": "helpful_count < 0",
        },
    ),
)
def review_contract(m: SampleModel):
    k = F.col("review_id")
    dirty = m.review_facts.select(
        S.unless(k % 10 == 0, F.col("product_id")).alias("product_id"),
        S.unless(k % 9 == 0, F.col("rating") + F.when(k % 4 == 0, 2).otherwise(0)).alias("rating"),
        S.unless(k % 6 == 0, F.col("created_at")).alias("created_at"),
        F.when(k % 5 == 0, F.repeat("user_name", F.lit(50))).otherwise(F.col("user_name")).alias("user_name"),
        F.when(k % 8 == 0, -1).otherwise(F.col("helpful_count")).alias("helpful_count"),
    )
    return V.violation_counts(dirty, V.REVIEW)


@query(
    "V3",
    breaks_sql(
        """
SELECT CASE WHEN product_id % 5 = 0 THEN NULL WHEN product_id % 5 = 1 THEN -price ELSE price END AS price,
       original_price - CASE WHEN product_id % 3 = 0 THEN 60000 ELSE 0 END AS original_price,
       discount_percent + CASE WHEN product_id % 4 = 0 THEN 95 ELSE 0 END AS discount_percent,
       stock_available - 25 AS stock_available FROM m_prices""",
        {
            "price_min": "price IS NULL OR price < 0",
            "original_price_min": "original_price < 0",
            "discount_range": "discount_percent NOT BETWEEN 0 AND 100",
            "stock_min": "stock_available < 0",
        },
    ),
)
def price_contract(m: SampleModel):
    k = F.col("product_id")
    dirty = m.product_prices.select(
        F.when(k % 5 == 1, -F.col("price")).when(k % 5 != 0, F.col("price")).alias("price"),
        (F.col("original_price") - F.when(k % 3 == 0, 60000).otherwise(0)).alias("original_price"),
        (F.col("discount_percent") + F.when(k % 4 == 0, 95).otherwise(0)).alias("discount_percent"),
        (F.col("stock_available") - 25).alias("stock_available"),
    )
    return V.violation_counts(dirty, V.PRICE)


@query(
    "V4",
    breaks_sql(
        """
SELECT shop_id, CASE WHEN shop_id % 6 = 0 THEN '' ELSE shop_name END AS shop_name, rating, response_rate, follower_count FROM m_shops""",
        {
            "shop_id_required": "shop_id IS NULL",
            "shop_name_length": "coalesce(length(shop_name), 0) NOT BETWEEN 1 AND 255",
            "rating_range": "rating NOT BETWEEN 0 AND 5",
            "response_rate_range": "response_rate NOT BETWEEN 0 AND 100",
            "follower_count_min": "follower_count < 0",
        },
    ),
)
def shop_contract(m: SampleModel):
    name = F.when(F.col("shop_id") % 6 == 0, "").otherwise(F.col("shop_name"))
    return V.violation_counts(m.shops.withColumn("shop_name", name), V.SHOP)


@query(
    "V5",
    breaks_sql(
        "SELECT CASE WHEN n_nationkey % 4 = 0 THEN '' WHEN n_nationkey % 4 = 1 THEN repeat(n_name, 40) ELSE n_name END AS category_name FROM nation",
        {"category_name_length": "length(category_name) NOT BETWEEN 1 AND 255"},
    ),
)
def category_contract(m: SampleModel):
    k = F.col("n_nationkey")
    name = F.when(k % 4 == 0, "").when(k % 4 == 1, F.repeat("n_name", F.lit(40))).otherwise(F.col("n_name"))
    return V.violation_counts(m.raw("nation").select(name.alias("category_name")), V.CATEGORY)


@query(
    "V6",
    breaks_sql(
        """
SELECT CASE WHEN review_id % 5 = 0 THEN 'label_0' ELSE sentiment END AS sentiment,
       confidence_10k / 10000.0 + CASE WHEN review_id % 4 = 0 THEN 0.5 ELSE 0 END AS confidence_score FROM m_sentiment""",
        {
            "sentiment_known": "sentiment NOT IN ('positive', 'negative', 'neutral')",
            "confidence_range": "confidence_score NOT BETWEEN 0 AND 1",
        },
    ),
)
def sentiment_contract(m: SampleModel):
    k = F.col("review_id")
    dirty = m.review_sentiment.select(
        F.when(k % 5 == 0, "label_0").otherwise(F.col("sentiment")).alias("sentiment"),
        (F.col("confidence_score") + F.when(k % 4 == 0, 0.5).otherwise(0.0).cast("decimal(2,1)")).alias("confidence_score"),
    )
    return V.violation_counts(dirty, V.SENTIMENT)


@query(
    "V7",
    """
SELECT 'reviews' AS table_name, 'rating_1_5' AS rule, count(*) AS checked, count(CASE WHEN rating NOT BETWEEN 1 AND 5 THEN 1 END) AS violations FROM m_facts
UNION ALL SELECT 'order_lines', 'quantity_positive', count(*), count(CASE WHEN quantity <= 10 THEN 1 END) FROM m_lines
UNION ALL SELECT 'crawl_categories', 'crawl_status_known', count(*), count(CASE WHEN n_nationkey % 5 = 0 THEN 1 END) FROM nation""",
)
def table_checks(m: SampleModel):
    # quantities are moved down and one state is renamed, so the checks have something to find
    lines = m.order_lines.withColumn("quantity", F.col("quantity") - 10)
    state = F.when(F.col("crawl_status") == "pending", "waiting").otherwise(F.col("crawl_status"))
    tables = {
        "reviews": m.review_facts,
        "order_lines": lines,
        "crawl_categories": m.crawl_categories.withColumn("crawl_status", state),
    }
    found = [
        V.violation_counts(df, V.TABLE_CHECKS[name]).withColumn("table_name", F.lit(name)) for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, found)


@query(
    "V7",
    """
SELECT 'lineitem' AS table_name, CAST(sum(c) AS BIGINT) AS n_rows, count(*) AS n_keys, count(CASE WHEN c > 1 THEN 1 END) AS repeated_keys
FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)
UNION ALL SELECT 'product_prices', CAST(sum(c) AS BIGINT), count(*), count(CASE WHEN c > 1 THEN 1 END)
FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_partkey, l_shipdate)""",
)
def key_uniqueness(m: SampleModel):
    lines = m.raw("lineitem")
    return V.uniqueness("lineitem", lines, ["l_orderkey", "l_linenumber"]).unionByName(
        V.uniqueness("product_prices", lines, ["l_partkey", "l_shipdate"])
    )


@query("V7", "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def repeated_line_keys(m: SampleModel):
    return V.duplicate_keys(m.raw("lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "V8",
    """
WITH few AS (SELECT p_partkey * 2 AS p_partkey FROM part)
SELECT 'products.shop_id' AS reference, 0 AS orphan_rows, 0 AS orphan_keys
UNION ALL SELECT 'product_prices.product_id', count(*), count(DISTINCT product_id) FROM m_prices WHERE product_id NOT IN (SELECT p_partkey FROM few)
UNION ALL SELECT 'reviews.product_id', count(*), count(DISTINCT product_id) FROM m_facts WHERE product_id NOT IN (SELECT p_partkey FROM few)
UNION ALL SELECT 'review_sentiment.review_id', 0, 0
UNION ALL SELECT 'order_lines.order_id', 0, 0
UNION ALL SELECT 'order_lines.product_id', count(*), count(DISTINCT product_id) FROM m_lines WHERE product_id NOT IN (SELECT p_partkey FROM few)""",
)
def referential_report(m: SampleModel):
    n_shops = m.raw("supplier").select(F.count("*")).scalar()
    # all products under the even numbers, so that rows of odd ones are orphans
    even = m.raw("part").select((F.col("p_partkey") * 2).alias("product_id"), (F.col("p_partkey") % n_shops).alias("shop_id"))
    return V.referential_report(
        {
            "products": even,
            "shops": m.shops,
            "product_prices": m.product_prices,
            "reviews": m.review_facts,
            "review_sentiment": m.review_sentiment,
            "orders": m.orders.select("order_id"),
            "order_lines": m.order_lines,
        }
    )


@query(
    "V9",
    """
SELECT review_id, '["' || concat_ws('","', CASE WHEN review_id = 0 THEN 'review_id' END, CASE WHEN product_id = 0 THEN 'product_id' END,
  CASE WHEN review_id % 11 = 0 OR user_id = 0 THEN 'customer_id' END) || '"]' AS missing
FROM m_facts WHERE review_id = 0 OR product_id = 0 OR review_id % 11 = 0 OR user_id = 0""",
)
def incomplete_order_messages(m: SampleModel):
    return V.missing_required(S.order_messages(m), ["review_id", "product_id", "customer_id"]).select("review_id", "missing")


@query(
    "V10",
    """
SELECT 'name' AS column_name, count(*) AS n_rows, count(*) - count(name) AS nulls, count(CASE WHEN trim(name) = '' THEN 1 END) AS blanks FROM m_products
UNION ALL SELECT 'sold_count', count(*), count(*) - count(sold_count), 0 FROM m_products
UNION ALL SELECT 'rating', count(*), count(*) - count(rating), 0 FROM m_products
UNION ALL SELECT 'authors', count(*), count(*) - count(authors), count(CASE WHEN trim(authors) = '' THEN 1 END) FROM m_products
UNION ALL SELECT 'first_seen', count(*), count(*) - count(first_seen), 0 FROM m_products""",
)
def data_quality_report(m: SampleModel):
    return V.null_report(m.products, ["name", "sold_count", "rating", "authors", "first_seen"])


@query(
    "V11",
    """
SELECT review_id, rating, helpful_count FROM m_facts
WHERE (rating IN (1, 5) AND helpful_count >= 50 AND user_name LIKE 'user_1%') OR (has_images AND helpful_count < 5 AND rating <> 3)""",
)
def review_filter(m: SampleModel):
    c = F.col
    strong = c("rating").isin(1, 5) & (c("helpful_count") >= 50) & c("user_name").like("user_1%")
    pictured = c("has_images") & (c("helpful_count") < 5) & (c("rating") != 3)
    return m.review_facts.filter(strong | pictured).select("review_id", "rating", "helpful_count")


@query(
    "V12",
    """
SELECT count(*) AS total_products, count(CASE WHEN review_count > 0 THEN 1 END) AS with_reviews, count(authors) AS with_authors,
       count(specifications) AS with_specs, count(CASE WHEN review_count > 0 OR authors IS NOT NULL THEN 1 END) AS with_detail
FROM m_products""",
)
def detail_coverage(m: SampleModel):
    return V.detail_coverage(m.products)


# merges ------------------------------------------------------------------------------------

PRODUCT_MESSAGES = f"""
SELECT p_partkey AS product_id, p_partkey * 10 + v AS seq, (p_partkey + v) % 2 = 0 AS all_keys, v,
       p_name || ' v' || v AS name, '{SITE}p' || p_partkey AS url,
       CASE WHEN v = 3 THEN 0 ELSE p_partkey % 50 + {N_SHOPS} - 5 END AS shop_id,
       CASE WHEN (p_partkey + v) % 5 <> 0 THEN CAST(p_partkey % 12 AS INTEGER) END AS category_id,
       CASE WHEN (p_partkey + v) % 3 <> 0 THEN p_size % 5 + 0.5 END AS rating,
       CASE WHEN (p_partkey + v) % 4 <> 0 THEN p_size * v END AS sold_count,
       CASE WHEN v <> 2 THEN p_brand || ' ' || v END AS description,
       CASE WHEN (p_partkey + v) % 7 = 0 THEN 0 WHEN (p_partkey + v) % 6 <> 0 THEN p_partkey % 100 + v * 10 END AS price,
       p_partkey % 100 + 500 AS original_price, CAST(p_partkey % 30 AS INTEGER) AS discount_percent,
       CASE WHEN v = 1 THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-01-02' END AS sent
FROM part, (VALUES (1), (2), (3)) x(v)"""


def _product_messages(m: SampleModel) -> DataFrame:
    return messages.decoded(messages.json_messages(S.product_messages(m), schemas.PRODUCT_MESSAGE))


def _stored_products(m: SampleModel) -> DataFrame:
    """All products under the even numbers: messages find half of theirs, and half of the table gets no message."""
    return m.products.select(
        (F.col("product_id") * 2).alias("product_id"),
        "name",
        "url",
        "shop_id",
        "category_id",
        "rating",
        "sold_count",
        F.col("short_description").alias("description"),
        F.col("first_seen"),
        F.col("first_seen").alias("last_updated"),
    )


def present_merge_sql(columns: dict[str, str]) -> str:
    """Last present value per column, else the stored one, else the default."""
    folds = ", ".join(
        f"arg_max({{'v': {c}}}, seq) FILTER (WHERE all_keys OR {c} IS NOT NULL) AS n_{c}" for c in columns
    )
    values = ", ".join(
        f"CASE WHEN n_{c} IS NOT NULL THEN n_{c}.v WHEN s.product_id IS NOT NULL THEN s.{c} ELSE {d} END AS {c}"
        for c, d in columns.items()
    )
    return f"""
WITH msgs AS ({PRODUCT_MESSAGES}),
folded AS (SELECT product_id AS pid, {folds} FROM msgs GROUP BY product_id),
stored AS (SELECT * REPLACE (product_id * 2 AS product_id), short_description AS description FROM m_products)
SELECT coalesce(pid, s.product_id) AS product_id, {values},
       strftime(CASE WHEN s.product_id IS NOT NULL THEN s.first_seen ELSE {PRICE_NOW} END, '%Y-%m-%d %H:%M:%S.%f') AS first_seen,
       strftime(CASE WHEN pid IS NULL THEN s.first_seen ELSE {PRICE_NOW} END, '%Y-%m-%d %H:%M:%S.%f') AS last_updated
FROM folded FULL JOIN stored s ON pid = s.product_id"""


@query(
    "U1 U12 Q4",
    present_merge_sql(
        {
            "name": "NULL", "url": "NULL", "shop_id": "NULL", "category_id": "NULL", "rating": "NULL",
            "sold_count": "0", "description": "NULL",
        }
    ),
)
def product_upsert(m: SampleModel):
    return U.upsert_products(_stored_products(m), _product_messages(m), m.price_time)


ENRICHED = ("name", "url", "shop_id", "category_id", "rating", "sold_count", "review_count", "discount_rate", "short_description", "authors")


@query(
    "U2 Q4",
    f"""
WITH d AS ({DETAIL_SQL}), s AS (SELECT * REPLACE (product_id * 2 AS product_id) FROM m_products)
SELECT coalesce(d.product_id, s.product_id) AS product_id, {', '.join(f'coalesce(d.{c}, s.{c}) AS {c}' for c in ENRICHED)}
FROM d FULL JOIN s ON d.product_id = s.product_id""",
)
def product_enrichment(m: SampleModel):
    stored = m.products.select((F.col("product_id") * 2).alias("product_id"), *ENRICHED)
    return U.enrich_products(stored, parse.product_details(S.detail_payloads(m), site=SITE), m.price_time)


TRUTHY_COLUMNS = ("sold_count", "price", "description")


@query(
    "U2 F12",
    f"""
SELECT product_id, {', '.join(f"arg_max({c}, seq) FILTER (WHERE {c} IS NOT NULL AND {t}) AS {c}" for c, t in
                             (('sold_count', 'sold_count <> 0'), ('description', "description <> ''")))},
       CAST(arg_max(price, seq) FILTER (WHERE price <> 0) AS DOUBLE) AS price
FROM ({PRODUCT_MESSAGES}) GROUP BY product_id""",
)
def last_truthy_values(m: SampleModel):
    return U.fold_updates(_product_messages(m), "product_id", TRUTHY_COLUMNS, "truthy").select(
        "product_id", *TRUTHY_COLUMNS
    )


@query(
    "U3 Q12",
    f"""
WITH fresh AS (
  SELECT product_id, sent, arg_min(price, seq) AS price, arg_min(original_price, seq) AS original_price,
         arg_min(discount_percent, seq) AS discount_percent
  FROM ({PRODUCT_MESSAGES}) WHERE price <> 0 GROUP BY product_id, sent)
SELECT product_id, {ts('ts', '"timestamp"')}, {dbl('price')}, {dbl('original_price')}, discount_percent, stock_available FROM m_prices
UNION ALL SELECT product_id, strftime(sent, '%Y-%m-%d %H:%M:%S.%f'), CAST(price AS DOUBLE), CAST(original_price AS DOUBLE), discount_percent, NULL FROM fresh""",
)
def price_append(m: SampleModel):
    sent = _product_messages(m).withColumn("timestamp", F.col("crawled_at").cast("timestamp"))
    once = U.append_prices(m.product_prices, sent)
    # the same messages again add nothing
    return U.append_prices(once, sent)


@query(
    "U4",
    f"""
SELECT s_suppkey AS shop_id, s_name AS shop_name, s_suppkey % 10 = 0 AS is_official FROM supplier
UNION ALL SELECT shop_id, 'Shop ' || shop_id, false FROM (
  SELECT DISTINCT shop_id FROM ({PRODUCT_MESSAGES}) WHERE shop_id <> 0 AND shop_id NOT IN (SELECT s_suppkey FROM supplier))""",
)
def shop_placeholders(m: SampleModel):
    return U.ensure_shops(m.shops.select("shop_id", "shop_name", "is_official"), _product_messages(m))


@query(
    "U4",
    f"""
WITH d AS (SELECT shop_id, arg_max(shop_name, product_id) AS n FROM ({DETAIL_SQL}) WHERE shop_id IS NOT NULL GROUP BY 1),
s AS (SELECT * REPLACE (shop_id * 2 AS shop_id) FROM m_shops)
SELECT coalesce(d.shop_id, s.shop_id) AS shop_id, coalesce(n, shop_name, 'Shop ' || d.shop_id) AS shop_name,
       coalesce(is_official, false) AS is_official
FROM s FULL JOIN d ON s.shop_id = d.shop_id""",
)
def shop_upsert(m: SampleModel):
    stored = m.shops.select((F.col("shop_id") * 2).alias("shop_id"), "shop_name", "is_official")
    return U.upsert_shops(stored, parse.product_details(S.detail_payloads(m)))


@query(
    "U5",
    f"""
SELECT category_id, category_name FROM m_categories
UNION ALL SELECT category_id, 'Category ' || category_id FROM (
  SELECT DISTINCT category_id FROM ({PRODUCT_MESSAGES}) WHERE category_id <> 0 AND category_id NOT IN (SELECT category_id FROM m_categories))""",
)
def category_placeholders(m: SampleModel):
    return U.ensure_categories(m.categories.select("category_id", "category_name"), _product_messages(m))


@query(
    "U6 U8 T5",
    f"SELECT seq, review_id, product_id, rating FROM ({REVIEW_DETAIL_SQL}) WHERE seq % 2 = 0 AND review_id NOT IN (SELECT review_id * 10 + 1 FROM m_facts)",
)
def new_reviews(m: SampleModel):
    """First message of each review that is not stored yet."""
    sent = parse.review_details(S.review_messages(m).select("seq", "value"), m.review_time)
    stored = m.review_facts.select((F.col("review_id") * 10 + 1).alias("review_id"))
    return U.new_rows(sent.select("seq", "review_id", "product_id", "rating"), stored, "review_id")


@query(
    "U9 U12 D3",
    f"""
WITH o AS (SELECT user_id AS customer_id, arg_max(CASE WHEN review_id % 4 = 0 THEN 'Full ' || user_name ELSE user_name END, review_id) AS n
  FROM m_facts WHERE review_id % 11 <> 0 AND user_id <> 0 GROUP BY 1),
c AS (SELECT customer_id * 3 AS customer_id, CASE WHEN customer_id % 2 = 0 THEN 'user_' || customer_id * 3 ELSE customer_name END AS customer_name FROM m_customers)
SELECT coalesce(o.customer_id, c.customer_id) AS customer_id, coalesce(n, customer_name) AS customer_name,
       strftime(CASE WHEN n IS NOT NULL AND n IS DISTINCT FROM customer_name THEN {REVIEW_NOW} ELSE TIMESTAMP '2020-01-01' END, '%Y-%m-%d %H:%M:%S.%f') AS last_updated
FROM c FULL JOIN o ON c.customer_id = o.customer_id""",
)
def customer_upsert(m: SampleModel):
    k = F.col("customer_id")
    name = F.when(k % 2 == 0, F.concat(F.lit("user_"), k * 3)).otherwise(F.col("customer_name"))
    stored = m.customers.select(
        (k * 3).alias("customer_id"), name.alias("customer_name"), F.lit("2020-01-01").cast("timestamp").alias("last_updated")
    )
    return U.upsert_customers(stored, S.order_messages(m), m.review_time)


@query(
    "U10",
    f"""
WITH items AS (
  SELECT p_partkey % {N_SHOPS} AS shop_id, max(p_partkey) AS last FROM part
  WHERE p_partkey % 4 <> 0 AND p_partkey % {N_SHOPS} <> 0 GROUP BY 1),
s AS (SELECT * REPLACE (shop_id * 3 AS shop_id) FROM m_shops)
SELECT coalesce(i.shop_id, s.shop_id) AS shop_id, CASE WHEN i.shop_id IS NOT NULL THEN 'Shop ' || i.shop_id ELSE shop_name END AS shop_name,
       CASE WHEN i.shop_id IS NOT NULL THEN last % 10 = 1 ELSE is_official END AS is_official, follower_count
FROM s FULL JOIN items i ON s.shop_id = i.shop_id""",
)
def shop_overwrite(m: SampleModel):
    stored = m.shops.select((F.col("shop_id") * 3).alias("shop_id"), "shop_name", "is_official", "follower_count")
    # elements are numbered in message order
    items = parse.shop_items(S.listing_elements(m), keep=(F.col("p_partkey").alias("seq"),))
    return U.overwrite_rows(stored, items, "shop_id", ["follower_count"], m.review_time)


@query(
    "U11",
    """
SELECT category_id, category_name, crawl_status, is_active FROM m_crawl
UNION ALL SELECT n_nationkey + 10, 'new ' || n_name, 'pending', true FROM nation WHERE n_nationkey + 10 NOT IN (SELECT category_id FROM m_crawl)""",
)
def added_categories(m: SampleModel):
    stored = m.crawl_categories.select("category_id", "category_name", "crawl_status", "is_active")
    new = m.raw("nation").select((F.col("n_nationkey") + 10).alias("category_id"), F.concat(F.lit("new "), "n_name").alias("category_name"))
    return C.add_categories(stored, new)


NORMAL = f"trim(regexp_replace(lower(text), '{SPACE}+', ' ', 'g'))"


@query("U13", f"SELECT sha256({NORMAL}) AS digest, min(doc_id) AS kept_id, count(*) AS copies FROM documents GROUP BY 1")
def duplicate_texts(m: SampleModel):
    return U.duplicate_groups(m.documents, "doc_id", "text")


@query("U13", f"SELECT doc_id, n_chars FROM documents WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY {NORMAL})")
def texts_without_duplicates(m: SampleModel):
    kept = U.without_duplicates(m.documents.select("doc_id", "n_chars", "text"), "doc_id", "text")
    return kept.select("doc_id", "n_chars")


@query(
    "U13",
    """
SELECT md AS product_name, min(p_partkey) AS kept_id, count(*) AS copies
FROM (SELECT lower(p_name) AS md, p_partkey FROM part) GROUP BY 1""",
)
def duplicate_products(m: SampleModel):
    groups = U.duplicate_groups(m.raw("part"), "p_partkey", "p_name")
    names = m.raw("part").select(F.col("p_partkey").alias("kept_id"), F.lower("p_name").alias("product_name"))
    return groups.join(names, "kept_id").select("product_name", "kept_id", "copies")


def similar_sql(tokens: str) -> str:
    """Groups by the true Jaccard similarity of all pairs; `tokens` gives (key, token) once each, and a null token where a row has none."""
    return f"""
WITH RECURSIVE tokens AS ({tokens}),
sizes AS (SELECT key, count(token) AS n FROM tokens GROUP BY 1),
links AS (
  SELECT a.key AS u, b.key AS v FROM tokens a JOIN tokens b ON a.token = b.token AND a.key <> b.key
  JOIN sizes x ON x.key = a.key JOIN sizes y ON y.key = b.key GROUP BY 1, 2, x.n, y.n HAVING 9 * count(*) >= 4 * (x.n + y.n)
  UNION ALL SELECT lowest, e.key FROM (SELECT s.key, min(s.key) OVER () AS lowest FROM sizes s WHERE n = 0) e
  UNION ALL SELECT e.key, lowest FROM (SELECT s.key, min(s.key) OVER () AS lowest FROM sizes s WHERE n = 0) e),
reached AS (SELECT key, key AS other FROM sizes UNION SELECT l.v, r.other FROM reached r JOIN links l ON l.u = r.key)
SELECT key, min(other) AS group_id FROM reached GROUP BY 1"""


@query(
    "U13",
    similar_sql(
        """
SELECT DISTINCT doc_id AS key, array_to_string(w[i:i + 4], ' ') AS token FROM (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents)
LEFT JOIN LATERAL unnest(CASE WHEN len(w) > 0 THEN range(1, greatest(len(w) - 4, 1) + 1) END) AS u(i) ON true"""
    ).replace("SELECT key, min", "SELECT key AS doc_id, min"),
)
def near_duplicate_reviews(m: SampleModel):
    """Review texts that share four fifths of their runs of five words, directly or over others."""
    return near.near_duplicate_groups(m.documents, "doc_id", near.word_shingles("text"))


@query(
    "U13",
    similar_sql(
        """
SELECT DISTINCT p_partkey AS key, t[i:i + 2] AS token FROM (SELECT p_partkey, lower(p_name || ' ' || p_brand) AS t FROM part),
  unnest(range(1, greatest(length(t) - 2, 1) + 1)) AS u(i)"""
    ).replace("SELECT key, min", "SELECT key AS product_id, min"),
)
def near_duplicate_products(m: SampleModel):
    """Products whose names and brands share four fifths of their runs of three letters."""
    parts = m.raw("part").withColumnRenamed("p_partkey", "product_id")
    return near.near_duplicate_groups(parts, "product_id", near.character_runs(F.concat("p_name", F.lit(" "), "p_brand")))


# derived facts -----------------------------------------------------------------------------

ORDER_FACTS_SQL = f"""
SELECT review_id AS order_id, user_id AS customer_id, review_id, f.product_id,
       date_trunc('second', created_at) AS order_date, price
FROM m_facts f LEFT JOIN m_latest l ON f.product_id = l.product_id
WHERE review_id <> 0 AND f.product_id <> 0 AND review_id % 11 <> 0 AND user_id <> 0
  AND f.product_id IN (SELECT p_partkey * 2 FROM part)
  AND review_id NOT IN (SELECT order_id * 3 FROM m_orders)"""


def _order_facts(m: SampleModel) -> DataFrame:
    # products under the even numbers are known, and the orders stand for every third review
    known = m.raw("part").select((F.col("p_partkey") * 2).alias("product_id"))
    done = m.orders.select((F.col("order_id") * 3).alias("review_id"))
    return D.order_facts(S.order_messages(m), known, m.product_prices, done)


@query(
    "D1 U7 J9 J10",
    f"""
SELECT order_id, customer_id, review_id, {ts('order_date')}, {dbl('price', 'total_amount')}, 'completed' AS status
FROM ({ORDER_FACTS_SQL})""",
)
def orders_from_reviews(m: SampleModel):
    return D.orders_of(_order_facts(m))


@query(
    "D2",
    f"""
SELECT order_id AS order_line_id, order_id, product_id, 1 AS quantity, {dbl('price', 'unit_price')}, {dbl('price', 'subtotal')}
FROM ({ORDER_FACTS_SQL})""",
)
def order_lines_from_reviews(m: SampleModel):
    return D.order_lines_of(_order_facts(m))


@query(
    "D3",
    """
SELECT user_id AS customer_id, arg_max(CASE WHEN review_id % 4 = 0 THEN 'Full ' || user_name ELSE user_name END, review_id) AS customer_name
FROM m_facts WHERE review_id % 11 <> 0 AND user_id <> 0 GROUP BY 1""",
)
def customers_from_reviews(m: SampleModel):
    return D.customers_of(S.order_messages(m))


@query(
    "D4 F20 J7",
    f"""
SELECT review_id AS order_id, CAST(('0x' || substr(md5(user_name), 1, 8)) AS BIGINT) % 1000000000 AS customer_id,
       user_name AS customer_name, review_id, f.product_id, {ts('created_at', 'order_date')}, 1 AS quantity,
       coalesce(CAST(price AS DOUBLE), 100000.0) AS unit_price, coalesce(CAST(price AS DOUBLE), 100000.0) AS total_amount,
       'completed' AS status
FROM m_facts f JOIN part ON p_partkey = f.product_id
LEFT JOIN m_latest l ON f.product_id = l.product_id * 2
WHERE review_id NOT IN (SELECT order_id * 3 FROM m_orders)""",
)
def order_backfill(m: SampleModel):
    done = m.orders.select((F.col("order_id") * 3).alias("review_id"))
    products = m.raw("part").select(F.col("p_partkey").alias("product_id"))
    # all prices under the even numbers: the other products have none, so that the default is used
    priced = m.product_prices.withColumn("product_id", F.col("product_id") * 2)
    return D.backfill_orders(m.review_facts, done, products, priced)


# reviews are younger than every price here, so they are moved back into the years of the prices, each by its own span
MOVED = "created_at - to_days(CAST(6000 + review_id % 3000 AS INTEGER))"


@query(
    "D4 J10",
    f"""
WITH moved AS (SELECT * REPLACE ({MOVED} AS created_at) FROM m_facts),
priced AS (SELECT moved.*, l.price FROM moved ASOF LEFT JOIN m_prices l ON moved.product_id = l.product_id AND moved.created_at >= l.ts)
SELECT review_id AS order_id, f.product_id, {ts('created_at', 'order_date')}, coalesce(CAST(price AS DOUBLE), 100000.0) AS unit_price
FROM priced f JOIN part ON p_partkey = f.product_id
WHERE review_id NOT IN (SELECT order_id * 3 FROM m_orders)""",
)
def order_backfill_at_own_time(m: SampleModel):
    done = m.orders.select((F.col("order_id") * 3).alias("review_id"))
    products = m.raw("part").select(F.col("p_partkey").alias("product_id"))
    days = -(F.lit(6000) + F.col("review_id") % 3000)
    moved = m.review_facts.withColumn("created_at", F.timestamp_add("DAY", days, F.col("created_at")))
    orders = D.backfill_orders(moved, done, products, m.product_prices, own_time=True)
    return orders.select("order_id", "product_id", "order_date", "unit_price")


@query(
    "J10 D1 D2",
    f"""
WITH dated AS (SELECT l.order_id, l.line_no, l.product_id, order_date FROM m_lines l JOIN m_orders USING (order_id))
SELECT d.order_id, d.line_no, d.product_id, {ts('order_date')}, {dbl('p.price', 'price')}
FROM dated d ASOF LEFT JOIN m_prices p ON d.product_id = p.product_id AND d.order_date >= p.ts""",
)
def order_lines_at_own_price(m: SampleModel):
    """Order lines with the price that was in force when they were ordered."""
    dates = m.orders.select("order_id", "order_date")
    lines = m.order_lines.select("order_id", "line_no", "product_id").join(dates, "order_id")
    return as_of_join(lines, m.product_prices, "product_id", "order_date", "timestamp", ["price"])


@query(
    "D5 J8 K6",
    """
SELECT review_id, product_id, rating FROM m_facts WHERE review_id NOT IN (SELECT review_id FROM m_sentiment)
ORDER BY review_id LIMIT 500""",
)
def sentiment_backfill_queue(m: SampleModel):
    rows = m.review_facts.select("review_id", "product_id", "rating")
    return D.backfill_sentiment_queue(rows, m.review_sentiment, 500)


@query("D5", "SELECT count(*) AS to_queue FROM m_facts WHERE review_id NOT IN (SELECT review_id FROM m_sentiment)")
def sentiment_backfill_size(m: SampleModel):
    return D.backfill_size(m.review_facts, m.review_sentiment)


# scoring -----------------------------------------------------------------------------------

# The sample prose is invented, so its frequent word parts stand in for opinion words.
SAMPLE_LEXICON = M.Lexicon(
    positive=frozenset({"ble", "ing", "ly", "elle", "best"}),
    negative=frozenset({"ed", "st", "sch", "worthless", "idiot", "stupid"}),
)


def lexicon_sql(key: str, text: str, source: str) -> str:
    count = lambda ws: f"len([x FOR x IN w IF x IN ({', '.join(repr(x) for x in sorted(ws))})])"
    return f"""
SELECT {key}, CASE WHEN pos > neg THEN 'positive' WHEN pos < neg THEN 'negative' ELSE 'neutral' END AS sentiment,
       CASE WHEN pos = neg THEN 0.0 ELSE round(1 / (1 + exp(-abs(CAST(pos - neg AS DOUBLE)))), 4) END AS confidence
FROM (SELECT {key}, {count(SAMPLE_LEXICON.positive)} AS pos, {count(SAMPLE_LEXICON.negative)} AS neg
      FROM (SELECT {key}, regexp_split_to_array(lower({text}), '[^\\p{{L}}]+') AS w FROM {source}))"""


@query("M1", lexicon_sql("review_id", "comment", "m_reviews"))
def review_sentiment_scores(m: SampleModel):
    # reviews share texts here: each text is scored once, before it meets its reviews
    scored = M.score_with_lexicon(m.documents.select("doc_id", "text"), "text", SAMPLE_LEXICON).drop("text")
    return m.review_facts.select("review_id", "doc_id").join(scored, "doc_id").select("review_id", "sentiment", "confidence")


def _sample_model() -> M.Model:
    return M.LexiconModel(SAMPLE_LEXICON)


@query("M1 M2", lexicon_sql("doc_id", "text", "documents"))
def model_sentiment_scores(m: SampleModel):
    scored = M.score_with_model(m.documents.select("doc_id", "text"), _sample_model, "text")
    return scored.select("doc_id", "sentiment", "confidence")


@query(
    "M3",
    """
WITH v AS (SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS e FROM embeddings),
x AS (SELECT vec_id, e, list_max(e) AS top, [exp(y - list_max(e)) FOR y IN e] AS ex FROM v)
SELECT vec_id, CAST(list_position(e, top) - 1 AS INTEGER) AS predicted, round(1 / list_sum(ex), 6) AS confidence FROM x""",
)
def softmax_prediction(m: SampleModel):
    scores = F.col("embedding").cast("array<double>")
    return m.raw("embeddings").select(
        "vec_id",
        X.argmax(scores).alias("predicted"),
        F.round(F.array_max(X.softmax(scores)), 6).alias("confidence"),
    )


PREDICTIONS = f"""
SELECT CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' ELSE 'neutral' END AS label, sentiment
FROM labels JOIN ({lexicon_sql('doc_id', 'text', 'documents')}) USING (doc_id)"""


def _predictions(m: SampleModel) -> DataFrame:
    label = F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive").otherwise("neutral")
    texts = m.documents.select("doc_id", "text").join(m.raw("labels").select("doc_id", label.alias("label")), "doc_id")
    return M.score_with_lexicon(texts, "text", SAMPLE_LEXICON).select("label", "sentiment")


@query("M5", f"SELECT label, sentiment, count(*) AS n FROM ({PREDICTIONS}) GROUP BY 1, 2")
def sentiment_confusion(m: SampleModel):
    return M.confusion(_predictions(m))


@query(
    "M5",
    f"""
SELECT count(*) AS n, count(CASE WHEN label = sentiment THEN 1 END) AS correct,
       round(count(CASE WHEN label = sentiment THEN 1 END) * 1.0 / count(*), 4) AS accuracy FROM ({PREDICTIONS})""",
)
def sentiment_accuracy(m: SampleModel):
    return M.accuracy(_predictions(m))


# bookkeeping -------------------------------------------------------------------------------


@query(
    "A10",
    """
SELECT count(*) AS total, count(CASE WHEN is_active THEN 1 END) AS active, count(CASE WHEN crawl_status = 'pending' THEN 1 END) AS pending,
       count(CASE WHEN crawl_status = 'in_progress' THEN 1 END) AS in_progress, count(CASE WHEN crawl_status = 'completed' THEN 1 END) AS completed,
       count(CASE WHEN crawl_status = 'failed' THEN 1 END) AS failed, CAST(sum(total_products_crawled) AS BIGINT) AS total_products
FROM m_crawl""",
)
def crawl_status_counts(m: SampleModel):
    return C.status_counts(m.crawl_categories)


@query(
    "A11",
    """
SELECT CAST(sum(total_products_crawled) AS BIGINT) AS total_products, count(*) AS total_categories,
       count(CASE WHEN crawl_status = 'completed' THEN 1 END) AS completed_categories FROM m_crawl WHERE is_active""",
)
def crawl_totals(m: SampleModel):
    return C.crawl_totals(m.crawl_categories)


QUEUE = "category_id, category_name, priority, max_pages, crawl_status"


def _queue(df: DataFrame) -> DataFrame:
    return df.select(*QUEUE.split(", "))


@query(
    "O1 Q2",
    f"SELECT {QUEUE} FROM m_crawl WHERE is_active AND crawl_status IN ('pending', 'failed') ORDER BY priority DESC NULLS FIRST, category_id LIMIT 1",
)
def next_category(m: SampleModel):
    return _queue(C.next_category(m.crawl_categories))


@query(
    "O1 K5",
    f"SELECT {QUEUE} FROM m_crawl WHERE is_active AND crawl_status = 'completed' ORDER BY last_crawled_at ASC NULLS FIRST, priority DESC NULLS FIRST, category_id LIMIT 1",
)
def next_category_to_repeat(m: SampleModel):
    worked = m.crawl_categories.filter(~F.col("crawl_status").isin("pending", "failed"))
    return _queue(C.next_category(worked))


@query("O2", f"SELECT {QUEUE} FROM m_crawl WHERE is_active AND crawl_status = 'pending' ORDER BY priority DESC NULLS FIRST, category_id LIMIT 1")
def next_pending_category(m: SampleModel):
    return _queue(C.next_pending(m.crawl_categories))


@query("O3", f"SELECT {QUEUE} FROM m_crawl WHERE is_active AND crawl_status IN ('pending', 'failed') ORDER BY priority DESC NULLS FIRST, category_id LIMIT 5")
def crawl_work_list(m: SampleModel):
    return _queue(C.work_list(m.crawl_categories, limit=5))


@query("O3", f"SELECT {QUEUE} FROM m_crawl WHERE is_active AND crawl_status = 'completed'")
def completed_work_list(m: SampleModel):
    return _queue(C.work_list(m.crawl_categories, "completed"))


@query("O4", f"SELECT {QUEUE} FROM m_crawl WHERE is_active")
def active_categories(m: SampleModel):
    return _queue(C.listing(m.crawl_categories, active_only=True))


@query("O4", f"SELECT {QUEUE} FROM m_crawl WHERE crawl_status = 'paused'")
def paused_categories(m: SampleModel):
    return _queue(C.listing(m.crawl_categories, "paused"))


@query("O8", "SELECT category_id, category_name, notes FROM m_crawl WHERE crawl_status = 'failed'")
def failed_categories(m: SampleModel):
    return C.failed(m.crawl_categories)


def action_fold(column: str, actions: str, value: str, stored: str) -> str:
    last = f"arg_max({{'v': {value}}}, event_id) FILTER (WHERE {actions})"
    return f"CASE WHEN {last} IS NOT NULL THEN ({last}).v ELSE any_value({stored}) END AS {column}"


@query(
    "O5 U12",
    f"""
WITH acts AS (
  SELECT CAST(event_id % 40 AS INTEGER) AS cid, event_id, ts,
         list_extract(['activate', 'deactivate', 'reset', 'status'], event_id % 7 % 4 + 1) AS action,
         list_extract(['in_progress', 'completed', 'failed'], event_id % 3 + 1) AS status,
         CASE WHEN event_id % 3 = 2 THEN 'code ' || event_id END AS message FROM events),
both_sides AS (SELECT * FROM m_crawl LEFT JOIN acts ON cid = category_id)
SELECT category_id, {action_fold('is_active', "action IN ('activate', 'deactivate')", "action = 'activate'", 'is_active')},
       {action_fold('crawl_status', "action IN ('reset', 'status')", "CASE WHEN action = 'reset' THEN 'pending' ELSE status END", 'crawl_status')},
       {action_fold('last_crawled_page', "action = 'reset'", '0', 'last_crawled_page')},
       {action_fold('total_products_crawled', "action = 'reset'", '0', 'total_products_crawled')},
       strftime(CASE WHEN arg_max({{'v': ts}}, event_id) FILTER (WHERE action IN ('reset', 'status')) IS NOT NULL
         THEN (arg_max({{'v': CASE WHEN action = 'status' THEN ts END}}, event_id) FILTER (WHERE action IN ('reset', 'status'))).v
         ELSE any_value(last_crawled_at) END, '%Y-%m-%d %H:%M:%S.%f') AS last_crawled_at,
       {action_fold('notes', "action = 'status' AND message IS NOT NULL", "'Error: ' || message", 'notes')}
FROM both_sides GROUP BY category_id""",
)
def queue_actions(m: SampleModel):
    stored = m.crawl_categories.select("category_id", *C.UPDATABLE)
    return C.apply_actions(stored, S.crawl_actions(m), m.review_time)


@query(
    "O6 F14 W3",
    """
SELECT crawler_type, page AS last_page, page + 1 AS start_page FROM (
  SELECT crawler_type, items_crawled AS page, row_number() OVER (PARTITION BY crawler_type ORDER BY started_at DESC, log_id DESC) AS rn
  FROM m_logs WHERE status IN ('running', 'completed')) WHERE rn = 1""",
)
def resume_pages(m: SampleModel):
    return C.resume_pages(m.crawl_logs)


RUN_EVENTS = """
SELECT user_id AS run_id, event_id AS seq, ts AS t, CAST(props ->> '$.k' AS INTEGER) AS k,
       CASE event_type WHEN 'signup' THEN 'start' WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'close' ELSE 'page' END AS kind
FROM events"""


@query(
    "O7 F4",
    f"""
SELECT run_id, CASE WHEN closed IS NULL THEN 'running' WHEN last_k % 2 = 0 THEN 'completed' ELSE 'failed' END AS status,
       items_crawled, errors_count, 'Last page: ' || coalesce(last_page, 0) AS page_note, {ts('started', 'started_at')},
       {ts('closed', 'completed_at')}, CAST(floor((epoch_us(closed) - epoch_us(started)) / 1000000.0) AS BIGINT) AS duration_seconds
FROM (SELECT run_id, CAST(coalesce(sum(CASE WHEN kind = 'page' THEN k % 10 END), 0) AS BIGINT) AS items_crawled,
             count(CASE WHEN kind = 'error' THEN 1 END) AS errors_count,
             arg_max(k, seq) FILTER (WHERE kind IN ('start', 'page')) AS last_page,
             min(t) FILTER (WHERE kind = 'start') AS started, max(t) FILTER (WHERE kind = 'close') AS closed,
             arg_max(k, seq) FILTER (WHERE kind = 'close') AS last_k
      FROM ({RUN_EVENTS}) GROUP BY run_id)""",
)
def run_log(m: SampleModel):
    return C.run_log(S.run_events(m))


@query(
    "O7 A14",
    f"""
WITH e AS ({RUN_EVENTS}), p AS (SELECT run_id, max(seq) AS page_seq FROM e WHERE kind IN ('start', 'page') GROUP BY 1)
SELECT e.run_id, row_number() OVER (PARTITION BY e.run_id ORDER BY seq) AS line_no, 'msg ' || seq AS message
FROM e LEFT JOIN p ON e.run_id = p.run_id WHERE kind = 'error' AND seq > coalesce(page_seq, -1)""",
)
def run_messages(m: SampleModel):
    return C.run_messages(S.run_events(m))


@query(
    "O9",
    """
SELECT category_id, CAST(unnest(range(last_crawled_page + 1, last_crawled_page + 1 + max_pages)) AS INTEGER) AS page FROM m_crawl""",
)
def request_grid(m: SampleModel):
    return C.request_grid(m.crawl_categories, "category_id", F.col("last_crawled_page") + 1, F.col("max_pages"))


@query(
    "O10",
    f"""
SELECT {ts("date_trunc('hour', started_at)", 'hour')}, count(*) AS runs,
       round(count(CASE WHEN status = 'completed' THEN 1 END) * 100.0 / nullif(count(CASE WHEN status IN ('completed', 'failed') THEN 1 END), 0), 2) AS success_percent,
       CAST(sum(items_crawled) AS BIGINT) AS items
FROM m_logs GROUP BY date_trunc('hour', started_at)""",
)
def hourly_crawl_activity(m: SampleModel):
    return C.hourly_activity(m.crawl_logs)


@query("O10", f"SELECT {ts('''date_trunc('hour', created_at)''', 'hour')}, count(*) AS reviews FROM m_facts GROUP BY date_trunc('hour', created_at)")
def reviews_per_hour(m: SampleModel):
    return C.hourly_arrivals(m.review_facts, "created_at", "reviews")


@query(
    "O10",
    f"""
SELECT crawler_type, {ts('max(started_at)', 'last_started')},
       CAST(floor((epoch_us({REVIEW_NOW}) - epoch_us(max(started_at))) / 1000000.0) AS BIGINT) AS age_seconds
FROM m_logs GROUP BY 1""",
)
def crawl_freshness(m: SampleModel):
    return C.freshness(m.crawl_logs, m.review_time)


@query(
    "F4",
    """
SELECT log_id, status, CAST(floor((epoch_us(completed_at) - epoch_us(started_at)) / 1000000.0) AS BIGINT) AS duration_seconds FROM m_logs""",
)
def run_durations(m: SampleModel):
    return C.run_durations(m.crawl_logs)
