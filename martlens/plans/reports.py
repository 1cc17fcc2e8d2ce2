"""Registered queries: joins, aggregations, windows, top-k and dashboards."""

from __future__ import annotations

from pyspark.sql import functions as F

from martlens.functions import scalars as X
from martlens.operators import aggregates as A, joins as J, prices as P, sentiment as M, topk as K
from martlens.plans import dashboards as B
from martlens.plans.oracle import PRICE_NOW, REVIEW_NOW, day, dbl, ts
from martlens.plans.registry import query
from martlens.plans.sample_model import SampleModel, n_rows

# joins -------------------------------------------------------------------------------------


@query(
    "B1 J1 J2 F1",
    f"""
SELECT p.product_id, p.name, p.shop_id, shop_name, p.category_id, category_name, rating, sold_count,
       review_count, discount_rate, {dbl('price')}, {dbl('original_price')}, discount_percent, {day('ts', 'date')}
FROM m_products p LEFT JOIN (SELECT shop_id, shop_name FROM m_shops) s ON p.shop_id = s.shop_id
LEFT JOIN m_categories c ON p.category_id = c.category_id
LEFT JOIN m_latest l ON p.product_id = l.product_id""",
)
def product_stats_daily(m: SampleModel):
    return B.product_stats_daily(m.products, m.shops, m.categories, m.product_prices)


@query(
    "J1",
    """
SELECT product_id, name, shop_name, category_name
FROM m_products p LEFT JOIN (SELECT shop_id, shop_name FROM m_shops) s USING (shop_id)
LEFT JOIN m_categories USING (category_id)""",
)
def products_with_dimensions(m: SampleModel):
    joined = J.with_dimensions(m.products, m.shops, m.categories)
    return joined.select("product_id", "name", "shop_name", "category_name")


@query(
    "J2 W3",
    f"""
SELECT product_id, {dbl('price')}, {dbl('original_price')}, discount_percent, stock_available,
       {ts('ts', 'price_timestamp')} FROM m_latest""",
)
def latest_price(m: SampleModel):
    return J.latest_price(m.product_prices)


@query(
    "J10",
    f"""
SELECT product_id, {dbl('price')}, {ts('ts', 'price_timestamp')} FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY ts DESC) AS rn
  FROM m_prices WHERE ts <= {PRICE_NOW} - INTERVAL 365 DAY) WHERE rn = 1""",
)
def latest_price_as_of(m: SampleModel):
    prices = m.product_prices.select("product_id", "price", "timestamp")
    return J.latest_price(prices, P.since(m.price_time, 365))


@query(
    "J3 A1 A14 F9 F10 F12",
    """
SELECT product_id, name, total_reviews, positive_count, negative_count, neutral_count,
       round(positive_count * 100.0 / nullif(total_reviews, 0), 2) AS positive_percentage,
       round(confidence_sum / 10000.0 / nullif(confidence_n, 0), 6) AS avg_confidence
FROM m_summary""",
)
def sentiment_summary(m: SampleModel):
    return A.sentiment_summary(m.products, m.review_facts, m.review_sentiment)


@query(
    "J5",
    f"""
SELECT o.order_id, customer_name, p.name AS product_name, quantity, {dbl('unit_price')},
       {dbl('total_amount')}, {ts('order_date')}
FROM m_orders o JOIN m_customers c ON o.customer_id = c.customer_id
JOIN m_lines l ON o.order_id = l.order_id JOIN m_products p ON l.product_id = p.product_id""",
)
def order_details(m: SampleModel):
    return J.order_details(m.orders, m.customers, m.order_lines, m.products)


@query(
    "J6",
    f"""
SELECT r.review_id, product_id, user_name, rating, comment, {ts('created_at')}, sentiment,
       confidence_10k / 10000.0 AS confidence_score, {ts('processed_at')}
FROM m_reviews r LEFT JOIN (SELECT review_id, sentiment, confidence_10k, processed_at FROM m_sentiment) s
  ON r.review_id = s.review_id
WHERE sentiment IS NOT NULL""",
)
def scored_review_detail(m: SampleModel):
    # texts come last, as they are much larger than all else and repeat
    rows = m.review_facts.select("review_id", "product_id", "user_name", "rating", "created_at", "doc_id")
    scored = J.scored_reviews(rows, m.review_sentiment)
    # a merge join leaves the reviews of one text side by side, and copies side by side take little room where they are written
    scored = scored.join(m.documents.select("doc_id", F.col("text").alias("comment")).hint("merge"), "doc_id")
    return scored.select(
        "review_id", "product_id", "user_name", "rating", "comment", "created_at", "sentiment", "confidence_score", "processed_at"
    )


@query(
    "J7",
    """
SELECT r.review_id, r.product_id FROM m_facts r LEFT JOIN m_orders o ON r.review_id = o.order_id * 3 WHERE o.order_id IS NULL""",
)
def reviews_without_order(m: SampleModel):
    # the orders stand for every third review
    done = m.orders.select((F.col("order_id") * 3).alias("review_id"))
    return J.without_match(m.review_facts.select("review_id", "product_id"), done, "review_id")


@query("J8", "SELECT review_id, rating FROM m_facts WHERE review_id NOT IN (SELECT review_id FROM m_sentiment)")
def reviews_without_sentiment(m: SampleModel):
    return J.without_match(m.review_facts.select("review_id", "rating"), m.review_sentiment, "review_id")


GUARD_SQL = "(SELECT p_partkey * 2 FROM part)"


def _known_products(m: SampleModel):
    """All products under the even numbers, so that odd ones are unknown."""
    return m.raw("part").select((F.col("p_partkey") * 2).alias("product_id"))


@query("J9", f"SELECT review_id, product_id, rating FROM m_facts WHERE product_id IN {GUARD_SQL}")
def reviews_of_known_products(m: SampleModel):
    rows = m.review_facts.select("review_id", "product_id", "rating")
    return J.with_parent(rows, _known_products(m), "product_id")


@query(
    "J9 V8",
    f"SELECT review_id, product_id, 'unknown product' AS reason FROM m_facts WHERE product_id NOT IN {GUARD_SQL}",
)
def reviews_of_unknown_products(m: SampleModel):
    rows = m.review_facts.select("review_id", "product_id")
    return J.orphans(rows, _known_products(m), "product_id", "unknown product")


@query(
    "J11 K3",
    f"""
SELECT r.review_id, r.product_id, user_name, r.rating, comment, {ts('created_at')}, p.name AS product_name
FROM m_reviews r JOIN m_products p ON r.product_id = p.product_id
ORDER BY r.created_at DESC, r.review_id LIMIT 10""",
)
def newest_reviews(m: SampleModel):
    return K.newest_reviews(m.reviews, m.products)


@query(
    "J12",
    """
SELECT c.category_id, c.category_name, c.parent_id, p.category_name AS parent_name
FROM m_tree c LEFT JOIN m_tree p ON c.parent_id = p.category_id""",
)
def category_parents(m: SampleModel):
    return J.parent_names(m.category_tree)


@query(
    "J12",
    """
WITH RECURSIVE walk AS (
  SELECT category_id, category_name AS path, 1 AS depth FROM m_tree WHERE parent_id IS NULL
  UNION ALL
  SELECT t.category_id, path || ' / ' || t.category_name, depth + 1 FROM m_tree t JOIN walk w ON t.parent_id = w.category_id)
SELECT category_id, path, depth, true AS complete FROM walk""",
)
def category_paths(m: SampleModel):
    return J.category_paths(m.category_tree)


@query(
    "J12",
    """
WITH RECURSIVE tree AS (
  SELECT p_partkey AS category_id, p_brand AS category_name,
         CASE WHEN p_partkey % 12 > 0 THEN p_partkey - 1 WHEN p_partkey % 60 = 48 THEN p_partkey + 11 END AS parent_id
  FROM part),
walk AS (
  SELECT category_id, category_name AS path, 1 AS depth, parent_id AS above FROM tree
  UNION ALL
  SELECT w.category_id, t.category_name || ' / ' || path, depth + 1, t.parent_id
  FROM walk w JOIN tree t ON t.category_id = w.above WHERE w.above <> w.category_id)
SELECT category_id, arg_max(path, depth) AS path, max(depth) AS depth,
       coalesce(arg_max(above, depth) <> category_id, true) AS complete
FROM (SELECT category_id, path, depth, coalesce(above, -1) AS above FROM walk) GROUP BY category_id""",
)
def deep_category_paths(m: SampleModel):
    return J.category_paths(m.deep_tree)


# aggregations ------------------------------------------------------------------------------


@query(
    "A2",
    """
SELECT r.product_id, any_value(p.name) AS product_name, count(*) AS total_reviews,
       count(CASE WHEN sentiment = 'positive' THEN 1 END) AS positive_count,
       count(CASE WHEN sentiment = 'negative' THEN 1 END) AS negative_count,
       count(CASE WHEN sentiment = 'neutral' THEN 1 END) AS neutral_count,
       round(sum(confidence_10k) / 10000.0 / count(*), 4) AS avg_confidence
FROM m_facts r JOIN m_sentiment s ON r.review_id = s.review_id JOIN m_products p ON r.product_id = p.product_id
GROUP BY r.product_id""",
)
def scored_product_summary(m: SampleModel):
    return A.scored_product_summary(m.products, m.review_facts, m.review_sentiment)


@query(
    "A2",
    """
SELECT r.product_id, any_value(p.name) AS product_name, count(*) AS total_reviews
FROM m_facts r JOIN m_sentiment s ON r.review_id = s.review_id JOIN m_products p ON r.product_id = p.product_id
GROUP BY r.product_id ORDER BY total_reviews DESC, r.product_id LIMIT 10""",
)
def most_scored_products(m: SampleModel):
    summary = A.scored_product_summary(m.products, m.review_facts, m.review_sentiment)
    return K.top_by(summary, F.desc("total_reviews"), "product_id", 10).select(
        "product_id", "product_name", "total_reviews"
    )


@query(
    "A3 W2 B10",
    """
SELECT sentiment, count(*) AS n, round(sum(confidence_10k) / 10000.0 / count(*), 4) AS avg_confidence,
       round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS percentage
FROM m_sentiment GROUP BY sentiment""",
)
def sentiment_distribution(m: SampleModel):
    return A.sentiment_distribution(m.review_sentiment)


@query(
    "A4 W2 B13",
    """
SELECT rating, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS percentage
FROM m_facts GROUP BY rating""",
)
def rating_distribution(m: SampleModel):
    return A.rating_distribution(m.review_facts)


@query(
    "A5",
    """
SELECT product_id, count(*) AS review_count, round(sum(rating) * 1.0 / count(*), 4) AS avg_rating,
       CAST(sum(CASE WHEN has_images THEN 1 ELSE 0 END) AS BIGINT) AS with_photos
FROM m_facts GROUP BY product_id""",
)
def review_stats(m: SampleModel):
    return A.review_stats(m.review_facts)


@query("A6 B13", "SELECT product_id, count(*) AS n_reviews FROM m_facts GROUP BY product_id")
def review_counts(m: SampleModel):
    return A.review_counts(m.review_facts)


@query(
    "A7 B12 F6",
    f"""
SELECT {day('processed_at', 'day')}, sentiment, count(*) AS n FROM m_sentiment
WHERE processed_at >= date_trunc('day', {REVIEW_NOW}) - INTERVAL 7 DAY GROUP BY 1, 2""",
)
def sentiment_trend(m: SampleModel):
    return A.sentiment_trend(m.review_sentiment, m.review_time)


PER_HOUR_SQL = """
SELECT strftime(date_trunc('hour', first_seen), '%Y-%m-%d %H:%M:%S.%f') AS hour, count(*) AS products_count
FROM m_products WHERE first_seen > (SELECT max(first_seen) FROM m_products) - INTERVAL {} HOUR GROUP BY 1"""


@query("A8 F3", PER_HOUR_SQL.format(24))
def products_per_hour_of_a_day(m: SampleModel):
    return A.products_per_hour(m.products, m.products.select(F.max("first_seen")).scalar())


# Sample products are first seen over years, so the report looks back further than a day.
@query(
    "A8 F3",
    PER_HOUR_SQL.format(2400),
)
def products_per_hour(m: SampleModel):
    newest = m.products.select(F.max("first_seen")).scalar()
    return A.products_per_hour(m.products, newest, hours=2400)


@query(
    "A9 T1 F2",
    f"""
SELECT product_id, strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S.%f') AS bucket,
       round(CAST(sum(price) AS DOUBLE) / count(*), 4) AS avg_price, {dbl('min(price)', 'min_price')},
       {dbl('max(price)', 'max_price')}, count(*) AS price_changes
FROM m_prices GROUP BY 1, 2""",
)
def hourly_price_rollup(m: SampleModel):
    return P.hourly_rollup(m.product_prices)


@query(
    "A12 B2",
    """
SELECT 'products' AS table_name, count(*) AS n_rows FROM part
UNION ALL SELECT 'shops', count(*) FROM supplier UNION ALL SELECT 'reviews', count(*) FROM events
UNION ALL SELECT 'product_prices', count(*) FROM m_prices UNION ALL SELECT 'customers', count(*) FROM customer
UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'TOTAL', (SELECT count(*) FROM part) + (SELECT count(*) FROM supplier) + (SELECT count(*) FROM events)
  + (SELECT count(*) FROM m_prices) + (SELECT count(*) FROM customer) + (SELECT count(*) FROM orders)""",
)
def table_counts(m: SampleModel):
    tables = {
        "products": m.raw("part"),
        "shops": m.shops,
        "reviews": m.review_facts,
        "product_prices": m.product_prices,
        "customers": m.customers,
        "orders": m.orders,
    }
    return A.table_counts(tables)


@query(
    "A13",
    """
SELECT r AS total_reviews, s AS scored_reviews, r - s AS unscored_reviews, round(s * 100.0 / r, 2) AS coverage_percent
FROM (SELECT (SELECT count(*) FROM events) AS r, (SELECT count(*) FROM m_sentiment) AS s)""",
)
def sentiment_coverage(m: SampleModel):
    return A.sentiment_coverage(m.review_facts, m.review_sentiment)


@query(
    "A14",
    """
SELECT category_name, short_description AS brand, CAST(row_number() OVER (PARTITION BY category_name ORDER BY short_description) AS INTEGER) AS place
FROM (SELECT DISTINCT category_name, short_description FROM m_products JOIN m_categories USING (category_id))""",
)
def brands_per_category(m: SampleModel):
    named = m.products.join(m.categories, "category_id").withColumnRenamed("short_description", "brand")
    return A.ordered_names(named, ["category_name"], "brand")


# windows and top-k -------------------------------------------------------------------------


def changes_sql(days: int, order: str) -> str:
    lag = "DESC" if order == "reference" else "ASC"
    return f"""
WITH compared AS (
  SELECT product_id, price, ts, lag(price) OVER w AS previous_price, lag(ts) OVER w AS previous_ts
  FROM m_prices WHERE ts >= {PRICE_NOW} - INTERVAL {days} DAY
  WINDOW w AS (PARTITION BY product_id ORDER BY ts {lag}))
SELECT c.product_id, p.p_name AS name, {dbl('price', 'current_price')}, {dbl('previous_price')},
       {dbl('price - previous_price', 'price_difference')},
       round(CAST(price - previous_price AS DOUBLE) * 100 / nullif(CAST(previous_price AS DOUBLE), 0), 2)
         AS price_change_percent,
       {ts('ts', 'current_timestamp')}, {ts('previous_ts', 'previous_timestamp')}
FROM compared c JOIN part p ON c.product_id = p.p_partkey
WHERE previous_price IS NOT NULL AND price <> previous_price"""


@query("W1 J4 F10 F11", changes_sql(60, "reference"))
def price_changes_reference(m: SampleModel):
    return P.price_changes(m.products, m.product_prices, m.price_time, 60, "reference")


@query("W1 J4", changes_sql(60, "chronological"))
def price_changes_chronological(m: SampleModel):
    return P.price_changes(m.products, m.product_prices, m.price_time, 60, "chronological")


@query("W1 J4", changes_sql(7, "reference"))
def price_changes_of_a_week(m: SampleModel):
    return P.price_changes(m.products, m.product_prices, m.price_time)


@query("W1", changes_sql(4000, "chronological"))
def price_changes_whole_history(m: SampleModel):
    # days are the resolution of the sample's times, so a month is a sensible slice here
    return P.price_changes(
        m.products, m.product_prices, m.price_time, 4000, "chronological", slice_width="month"
    )


@query(
    "W1 K3 F11",
    "SELECT * FROM ("
    + changes_sql(60, "reference").replace("WITH compared", "WITH compared", 1)
    + ") ORDER BY abs(price_difference) DESC, product_id, current_timestamp LIMIT 25",
)
def largest_price_changes(m: SampleModel):
    return P.largest_changes(P.price_changes(m.products, m.product_prices, m.price_time, 60), 25)


@query(
    "K1 Q2",
    f"""
SELECT p.product_id, p.name, shop_name, category_name, p.rating, sold_count, review_count, {dbl('price')}, discount_percent
FROM m_products p LEFT JOIN (SELECT shop_id, shop_name FROM m_shops) s ON p.shop_id = s.shop_id
LEFT JOIN m_categories c ON p.category_id = c.category_id LEFT JOIN m_latest l ON p.product_id = l.product_id
ORDER BY sold_count DESC NULLS FIRST, p.product_id LIMIT 100""",
)
def top_selling_products(m: SampleModel):
    return K.top_selling_products(m.products, m.shops, m.categories, m.product_prices)


@query(
    "B3",
    "SELECT product_id, name, sold_count FROM m_products ORDER BY sold_count DESC NULLS FIRST, product_id LIMIT 20",
)
def top_20_products(m: SampleModel):
    return K.top_selling(m.products.select("product_id", "name", "sold_count"), 20)


@query(
    "K2 P14",
    """
SELECT product_id, rank, review_id, user_name, rating, helpful_count, left(comment, 100) AS comment_preview FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY product_id ORDER BY helpful_count DESC NULLS FIRST, review_id) AS INTEGER) AS rank
  FROM m_reviews) WHERE rank <= 10""",
)
def helpful_reviews(m: SampleModel):
    return K.helpful_reviews(m.reviews)


@query(
    "K3",
    f"""
SELECT product_id, name, rating, sold_count, {ts('first_seen')} FROM m_products
ORDER BY m_products.first_seen DESC NULLS FIRST, product_id LIMIT 10""",
)
def newest_products(m: SampleModel):
    return K.newest_products(m.products)


@query(
    "K3 J6",
    f"""
SELECT r.review_id, rating, comment, sentiment, confidence_10k / 10000.0 AS confidence_score, {ts('processed_at')}
FROM m_reviews r JOIN (SELECT review_id, sentiment, confidence_10k, processed_at FROM m_sentiment) s
  ON r.review_id = s.review_id
ORDER BY s.processed_at DESC, r.review_id LIMIT 10""",
)
def newest_scored_reviews(m: SampleModel):
    return K.newest_scored(m.reviews, m.review_sentiment)


@query(
    "K4 V11",
    f"""
SELECT log_id, crawler_type, items_crawled, error_message, status, {ts('started_at')} FROM m_logs
WHERE crawler_type LIKE 'listing_cat_1%' ORDER BY m_logs.started_at DESC, log_id LIMIT 10""",
)
def latest_crawl_runs(m: SampleModel):
    return K.latest_runs(m.crawl_logs, 10, "listing_cat_1").select(
        "log_id", "crawler_type", "items_crawled", "error_message", "status", "started_at"
    )


@query(
    "K5",
    f"""
SELECT category_id, category_name, last_crawled_page, total_products_crawled, crawl_status, {ts('last_crawled_at')}
FROM m_crawl WHERE is_active""",
)
def crawl_progress(m: SampleModel):
    return K.crawl_progress(m.crawl_categories)


@query(
    "K6",
    """
SELECT review_id, row_number, (row_number - 1) // 100 AS chunk FROM (
  SELECT review_id, row_number() OVER (ORDER BY review_id) AS row_number FROM m_facts
  WHERE review_id NOT IN (SELECT review_id FROM m_sentiment))""",
)
def unscored_review_chunks(m: SampleModel):
    todo = J.without_match(m.review_facts.select("review_id"), m.review_sentiment, "review_id")
    return K.in_chunks(todo, "review_id", 100)


# dashboards --------------------------------------------------------------------------------


@query(
    "B2 O10",
    """
SELECT 'products' AS metric, count(*) AS value FROM part UNION ALL SELECT 'reviews', count(*) FROM events
UNION ALL SELECT 'shops', count(*) FROM supplier
UNION ALL SELECT 'crawls_completed', count(*) FROM m_logs WHERE status = 'completed'
UNION ALL SELECT 'crawls_failed', count(*) FROM m_logs WHERE status = 'failed'""",
)
def overview(m: SampleModel):
    return B.overview(m.raw("part"), m.review_facts, m.shops, m.crawl_logs)


@query(
    "B4",
    """
SELECT category_name, count(*) AS n_values, round(quantile_cont(CAST(price AS DOUBLE), 0.25), 4) AS p25,
       round(quantile_cont(CAST(price AS DOUBLE), 0.5), 4) AS median, round(quantile_cont(CAST(price AS DOUBLE), 0.75), 4) AS p75
FROM m_products JOIN m_latest USING (product_id) JOIN m_categories USING (category_id) GROUP BY 1""",
)
def category_price_percentiles(m: SampleModel):
    return B.category_price_percentiles(m.products, m.product_prices, m.categories)


@query(
    "B4",
    """
SELECT category_name, CAST(floor(CAST(price AS DOUBLE) / 10000) AS BIGINT) * 10000 AS price_from,
       CAST(floor(CAST(price AS DOUBLE) / 10000) AS BIGINT) * 10000 + 10000 AS price_below, count(*) AS n_products
FROM m_products JOIN m_latest USING (product_id) JOIN m_categories USING (category_id) GROUP BY 1, 2, 3""",
)
def category_price_histogram(m: SampleModel):
    return B.category_price_histogram(m.products, m.product_prices, m.categories)


@query("B5", "SELECT product_id, name, rating, review_count FROM m_products WHERE rating >= 4.5")
def best_rated(m: SampleModel):
    return B.highly_rated(m.products)


@query("B5", "SELECT product_id, name, rating, review_count FROM m_products WHERE rating >= 4.0")
def highly_rated(m: SampleModel):
    # sample ratings average about 3, so the mark is set a little lower than the usual 4.5
    return B.highly_rated(m.products, 4.0)


@query(
    "B6",
    f"""
SELECT product_id, p_name AS name, {dbl('price')}, {dbl('original_price')}, discount_percent
FROM m_latest JOIN part ON p_partkey = product_id ORDER BY discount_percent DESC NULLS LAST, product_id LIMIT 20""",
)
def biggest_discounts(m: SampleModel):
    return B.biggest_discounts(m.products, m.product_prices)


FLUCTUATION_SQL = """
SELECT product_id, count(*) AS n_prices,
       round(stddev_samp(CAST(price AS DOUBLE)) / nullif(avg(CAST(price AS DOUBLE)), 0), 4) AS volatility,
       round(CAST(max(price) - min(price) AS DOUBLE) / nullif(CAST(min(price) AS DOUBLE), 0), 4) AS span
FROM m_prices GROUP BY 1"""


@query("B7", FLUCTUATION_SQL)
def price_fluctuation(m: SampleModel):
    return P.fluctuation(m.product_prices)


@query(
    "B7",
    f"SELECT f.*, p_name AS name FROM ({FLUCTUATION_SQL}) f JOIN part ON p_partkey = product_id "
    "ORDER BY span DESC NULLS LAST, product_id LIMIT 20",
)
def most_volatile_products(m: SampleModel):
    return B.most_volatile(m.products, m.product_prices)


@query(
    "B8",
    """
SELECT category_id, category_name, round(CAST(sum(price) AS DOUBLE) / count(*), 4) AS avg_price, count(*) AS n_products
FROM m_products JOIN m_latest USING (product_id) JOIN m_categories USING (category_id) GROUP BY 1, 2""",
)
def average_price_by_category(m: SampleModel):
    return B.average_price(m.products, m.product_prices, "category_id", m.categories, "category_name")


@query(
    "B8",
    """
SELECT shop_id, s_name AS shop_name, round(CAST(sum(price) AS DOUBLE) / count(*), 4) AS avg_price, count(*) AS n_products
FROM m_products JOIN m_latest USING (product_id) JOIN supplier ON s_suppkey = shop_id GROUP BY 1, 2""",
)
def average_price_by_shop(m: SampleModel):
    return B.average_price(m.products, m.product_prices, "shop_id", m.shops, "shop_name")


@query(
    "B9",
    f"SELECT * FROM ({changes_sql(60, 'chronological')}) WHERE price_change_percent <= -10",
)
def price_drops(m: SampleModel):
    return B.price_drops(m.products, m.product_prices, m.price_time, 60)


def ranked_sql(label: str) -> str:
    return f"""
SELECT product_id, name, total_reviews, {label}_count, round({label}_count * 100.0 / total_reviews, 2) AS share
FROM m_summary WHERE total_reviews >= 3
ORDER BY share DESC NULLS LAST, total_reviews DESC, product_id LIMIT 10"""


@query("B10", ranked_sql("positive"))
def most_positive_products(m: SampleModel):
    return B.ranked_by_sentiment(A.sentiment_summary(m.products, m.review_facts, m.review_sentiment), "positive")


@query("B10", ranked_sql("negative"))
def most_negative_products(m: SampleModel):
    return B.ranked_by_sentiment(A.sentiment_summary(m.products, m.review_facts, m.review_sentiment), "negative")


STOP_WORDS = ("the", "of", "and", "to", "in", "de", "la", "der", "is", "that")
KEYWORDS_SQL = f"""
SELECT word, count(*) AS n FROM (
  SELECT unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}]+')) AS word FROM documents)
WHERE length(word) >= 2 AND word NOT IN {STOP_WORDS} GROUP BY 1"""


@query("B11", KEYWORDS_SQL)
def keyword_counts(m: SampleModel):
    return B.keyword_counts(m.documents, "text", stop_words=STOP_WORDS)


@query("B11", KEYWORDS_SQL + " ORDER BY n DESC, word LIMIT 100")
def keyword_cloud(m: SampleModel):
    return B.keyword_cloud(m.documents, text="text", stop_words=STOP_WORDS)


WEEKLY_SQL = """
SELECT product_id, date_trunc('week', processed_at) AS w, count(*) AS n,
       count(CASE WHEN sentiment = 'positive' THEN 1 END) AS positive
FROM m_facts JOIN (SELECT review_id, sentiment, processed_at FROM m_sentiment) USING (review_id) GROUP BY 1, 2"""


@query("B12", f"SELECT product_id, {day('w', 'week')}, n, positive FROM ({WEEKLY_SQL})")
def weekly_sentiment(m: SampleModel):
    return B.weekly_sentiment(m.review_facts, m.review_sentiment)


# All reviews of a sample product share one text and so one label; here the numbers go round one product fewer, which mixes texts.
MIXED_WEEKLY_SQL = """
SELECT review_id % (SELECT count(*) - 1 FROM part) AS product_id, date_trunc('week', processed_at) AS w, count(*) AS n,
       count(CASE WHEN sentiment = 'positive' THEN 1 END) AS positive
FROM m_sentiment GROUP BY 1, 2"""


@query(
    "B12",
    f"""
SELECT product_id, p_name AS name, weeks, slope FROM (
  SELECT product_id, count(*) AS weeks,
         round(regr_slope(CAST(positive AS DOUBLE) / n, datediff('day', DATE '1970-01-01', CAST(w AS DATE)) / 7.0), 6) AS slope
  FROM ({MIXED_WEEKLY_SQL}) GROUP BY 1) JOIN part ON p_partkey = product_id
WHERE weeks >= 2 AND slope < 0""",
)
def declining_sentiment(m: SampleModel):
    product = F.col("review_id") % (n_rows(m.raw("part")) - 1)
    return B.declining_sentiment(m.products, m.review_facts.select("review_id", product.alias("product_id")), m.review_sentiment)


@query(
    "B13",
    """
SELECT product_id, n_reviews, p_name AS name FROM (
  SELECT product_id, count(*) AS n_reviews FROM m_facts GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)
JOIN part ON p_partkey = product_id""",
)
def most_reviewed_products(m: SampleModel):
    return B.most_reviewed(m.products, m.review_facts)


@query(
    "B14",
    """
SELECT round(corr(rating, sold_count), 6) AS correlation,
       count(CASE WHEN rating IS NOT NULL AND sold_count IS NOT NULL THEN 1 END) AS n_products FROM m_products""",
)
def rating_sales_correlation(m: SampleModel):
    return B.rating_sales_correlation(m.products)


SHOPS_SQL = """
SELECT s.shop_id, shop_name, is_official, count(*) AS n_products,
       round(sum(p.rating) / count(p.rating), 4) AS avg_rating, CAST(sum(sold_count) AS BIGINT) AS units_sold,
       round(CAST(sum(price) AS DOUBLE) / count(price), 4) AS avg_price
FROM (SELECT shop_id, shop_name, is_official FROM m_shops) s JOIN m_products p ON s.shop_id = p.shop_id
LEFT JOIN m_latest l ON p.product_id = l.product_id GROUP BY 1, 2, 3"""


@query("B15", SHOPS_SQL)
def shop_comparison(m: SampleModel):
    return B.shop_comparison(m.products, m.product_prices, m.shops)


def top_shops_sql(by: str) -> str:
    return f"""
SELECT *, CAST(row_number() OVER (ORDER BY {by} DESC NULLS LAST, shop_id) AS INTEGER) AS place
FROM ({SHOPS_SQL}) ORDER BY {by} DESC NULLS LAST, shop_id LIMIT 10"""


@query("B15", top_shops_sql("n_products"))
def shops_with_most_products(m: SampleModel):
    return B.top_shops(B.shop_comparison(m.products, m.product_prices, m.shops), "n_products")


@query("B15", top_shops_sql("avg_rating"))
def best_rated_shops(m: SampleModel):
    return B.top_shops(B.shop_comparison(m.products, m.product_prices, m.shops), "avg_rating")


@query(
    "B16",
    f"SELECT *, CASE WHEN price_difference > 0 THEN 'up' ELSE 'down' END AS direction FROM ({changes_sql(60, 'chronological')})",
)
def price_moves(m: SampleModel):
    return B.price_moves(m.products, m.product_prices, m.price_time, 60)


SCORES_SQL = """
SELECT p.product_id, category_id,
       round(0.5 * rating / 5 + 0.5 * (CAST(positive_count AS DOUBLE) / total_reviews), 6) AS score
FROM m_products p JOIN m_summary s ON p.product_id = s.product_id
WHERE total_reviews >= 3 AND rating IS NOT NULL"""


@query("B17", SCORES_SQL)
def product_scores(m: SampleModel):
    return B.product_scores(m.products, A.sentiment_summary(m.products, m.review_facts, m.review_sentiment))


@query(
    "B17",
    f"""
WITH scores AS ({SCORES_SQL}),
best AS (SELECT *, row_number() OVER (PARTITION BY category_id ORDER BY score DESC, product_id) AS r FROM scores)
SELECT p.product_id, CAST(row_number() OVER (PARTITION BY p.product_id ORDER BY r) AS INTEGER) AS place,
       b.product_id AS recommended_id, b.score
FROM m_products p JOIN best b ON p.category_id = b.category_id AND b.product_id <> p.product_id AND r <= 4
QUALIFY place <= 3""",
)
def recommendations(m: SampleModel):
    summary = A.sentiment_summary(m.products, m.review_facts, m.review_sentiment)
    return B.recommendations(m.products, B.product_scores(m.products, summary))


@query(
    "B18",
    f"""
WITH counted AS (
  SELECT product_id, count(CASE WHEN created_at > {REVIEW_NOW} - INTERVAL 7 DAY THEN 1 END) AS recent,
         count(CASE WHEN created_at <= {REVIEW_NOW} - INTERVAL 7 DAY THEN 1 END) AS before
  FROM m_facts WHERE created_at > {REVIEW_NOW} - INTERVAL 14 DAY GROUP BY 1)
SELECT product_id, recent, before, round((recent + 1.0) / (before + 1), 4) AS growth, p_name AS name
FROM counted JOIN part ON p_partkey = product_id WHERE recent > 0 ORDER BY growth DESC, recent DESC, product_id LIMIT 10""",
)
def trending_products(m: SampleModel):
    return B.trending(m.products, m.review_facts, m.review_time)


@query(
    "B19",
    """
SELECT 'total_products' AS metric, CAST(count(*) AS DOUBLE) AS value FROM part
UNION ALL SELECT 'products in ' || category_name, CAST(count(*) AS DOUBLE) FROM m_products JOIN m_categories USING (category_id) GROUP BY category_name
UNION ALL SELECT 'average_price', round(CAST(sum(price) AS DOUBLE) / count(*), 4) FROM m_latest""",
)
def dashboard_starters(m: SampleModel):
    return B.starters(m.products, m.product_prices, m.categories)


@query(
    "B19",
    f"""
SELECT {ts("date_trunc('month', ts)", 'period')}, round(CAST(sum(price) AS DOUBLE) / count(*), 4) AS avg_price, count(*) AS n_prices
FROM m_prices GROUP BY date_trunc('month', ts)""",
)
def price_trend(m: SampleModel):
    return P.price_trend(m.product_prices)


@query(
    "M4",
    """
SELECT review_id, rating, sentiment, confidence_10k / 10000.0 AS confidence_score,
       CASE WHEN rating >= 4 THEN 'high_rating_negative' ELSE 'low_rating_positive' END AS mismatch
FROM m_facts JOIN (SELECT review_id, sentiment, confidence_10k FROM m_sentiment) USING (review_id)
WHERE (rating >= 4 AND sentiment = 'negative') OR (rating <= 2 AND sentiment = 'positive')""",
)
def rating_sentiment_mismatches(m: SampleModel):
    scored = J.scored_reviews(m.review_facts.select("review_id", "rating"), m.review_sentiment)
    return M.mismatches(scored).drop("processed_at")


@query(
    "M4",
    """
SELECT review_id, rating, sentiment, confidence_10k / 10000.0 AS confidence_score
FROM m_facts JOIN (SELECT review_id, sentiment, confidence_10k FROM m_sentiment) USING (review_id)
WHERE rating >= 4 AND sentiment = 'negative' ORDER BY confidence_10k DESC, review_id LIMIT 10""",
)
def confident_mismatches(m: SampleModel):
    scored = J.scored_reviews(m.review_facts.select("review_id", "rating"), m.review_sentiment)
    high = M.mismatches(scored).filter("mismatch = 'high_rating_negative'")
    return K.by_confidence(high, 10).drop("processed_at", "mismatch")


@query(
    "F1 F2 F3 F4 F5 F8 F9 F11 F13",
    """
SELECT review_id, strftime(created_at, '%Y-%m-%d') AS day,
       strftime(time_bucket(INTERVAL 1 HOUR, created_at), '%Y-%m-%d %H:%M:%S.%f') AS bucket,
       strftime(date_trunc('hour', created_at), '%Y-%m-%d %H:%M:%S.%f') AS hour,
       strftime(created_at, '%Y-%m-%d %H:%M') AS minute_label,
       strftime(created_at, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(created_at) % 1000000 = 0 THEN ''
         ELSE strftime(created_at, '.%f') END AS iso,
       left(user_name, 6) AS short_name, upper(user_name) AS shout, lower(trim('  ' || user_name || ' ')) AS tidy,
       split_part(user_name, '_', 2) AS number, abs(rating - 3) AS distance,
       CASE WHEN rating >= 4 THEN 'good' WHEN rating <= 2 THEN 'bad' ELSE 'fair' END AS verdict,
       nullif(rating, 3) AS not_fair
FROM m_facts""",
)
def time_and_text_functions(m: SampleModel):
    t = F.col("created_at")
    verdict = F.when(F.col("rating") >= 4, "good").when(F.col("rating") <= 2, "bad").otherwise("fair")
    return m.review_facts.select(
        "review_id",
        F.to_date(t).alias("day"),
        F.window(t, "1 hour").getField("start").alias("bucket"),
        X.hour_of(t).alias("hour"),
        X.minute_text(t).alias("minute_label"),
        X.iso_text(t).alias("iso"),
        F.left("user_name", F.lit(6)).alias("short_name"),
        F.upper("user_name").alias("shout"),
        F.lower(F.trim(F.concat(F.lit("  "), "user_name", F.lit(" ")))).alias("tidy"),
        F.element_at(F.split("user_name", "_"), 2).alias("number"),
        F.abs(F.col("rating") - 3).alias("distance"),
        verdict.alias("verdict"),
        F.nullif("rating", F.lit(3)).alias("not_fair"),
    )
