"""The model tables as DuckDB SQL, for checking; written apart from the Spark code."""

from __future__ import annotations

import re

MODEL = {
    "m_categories": """
SELECT CAST(row_number() OVER (ORDER BY p_type) AS INTEGER) AS category_id,
       p_type AS category_name, CAST(NULL AS INTEGER) AS parent_id
FROM (SELECT DISTINCT p_type FROM part)""",
    "m_tree": """
SELECT r_regionkey AS category_id, r_name AS category_name, CAST(NULL AS INTEGER) AS parent_id FROM region
UNION ALL SELECT n_nationkey + 100, n_name, n_regionkey FROM nation""",
    "m_shops": """
SELECT s_suppkey AS shop_id, s_name AS shop_name,
       CAST((s_suppkey % 12) * 0.5 AS DECIMAL(3,2)) AS rating,
       CAST(s_suppkey * 7 % 110 AS INTEGER) AS response_rate,
       CAST(s_suppkey * 13 % 5000 - 10 AS INTEGER) AS follower_count,
       s_suppkey % 10 = 0 AS is_official
FROM supplier""",
    "m_prices": """
SELECT l_partkey AS product_id, l_shipdate AS ts,
       max(CAST(l_extendedprice AS DECIMAL(12,2))) AS price,
       max(CAST(l_extendedprice AS DECIMAL(12,2))) + 1000 AS original_price,
       max(CAST(round(l_discount * 100) AS INTEGER)) AS discount_percent,
       max(CAST(l_quantity AS INTEGER)) AS stock_available
FROM lineitem GROUP BY l_partkey, l_shipdate""",
    "m_latest": """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY ts DESC) AS rn FROM m_prices)
WHERE rn = 1""",
    "m_facts": """
SELECT event_id AS review_id, event_id % (SELECT count(*) FROM part) AS product_id,
       'user_' || user_id AS user_name, 1 + CAST(floor(value) AS INTEGER) % 5 AS rating,
       event_type = 'view' AS has_images, CAST(props ->> '$.k' AS INTEGER) AS helpful_count,
       ts AS created_at, user_id, event_id % (SELECT count(*) FROM documents) AS doc_id
FROM events""",
    "m_reviews": """
SELECT m_facts.*, text AS comment FROM m_facts JOIN documents USING (doc_id)""",
    "m_sentiment": """
SELECT review_id, created_at AS processed_at,
       CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' ELSE 'neutral' END AS sentiment,
       CAST(n_chars % 10000 AS INTEGER) AS confidence_10k
FROM m_facts JOIN labels USING (doc_id) JOIN documents USING (doc_id)""",
    "m_products": """
SELECT p_partkey AS product_id, p_name AS name,
       p_partkey % (SELECT count(*) FROM supplier) AS shop_id, category_id,
       'https://shop.example/p' || p_partkey AS url, p_brand AS short_description,
       CAST(stars AS DOUBLE) / nullif(n, 0) AS exact_rating,
       CAST(round(CAST(stars AS DOUBLE) / nullif(n, 0), 2) AS DOUBLE) AS rating,
       CASE WHEN p_partkey % 97 <> 0 THEN sold END AS sold_count,
       CAST(coalesce(n, 0) AS INTEGER) AS review_count, coalesce(discount_rate, 0) AS discount_rate,
       first_seen,
       CASE WHEN p_partkey % 3 <> 0 THEN '[{"name":"' || p_brand || '"}]' END AS authors,
       CASE WHEN p_partkey % 4 <> 0 THEN '[{"name":"' || p_brand || '"}]' END AS specifications
FROM part
JOIN m_categories ON category_name = p_type
LEFT JOIN (SELECT l_partkey, CAST(sum(l_quantity) AS INTEGER) AS sold, min(l_shipdate) AS first_seen,
                  max(CAST(round(l_discount * 100) AS INTEGER)) AS discount_rate
           FROM lineitem GROUP BY 1) ON l_partkey = p_partkey
LEFT JOIN (SELECT product_id AS pid, count(*) AS n, sum(rating) AS stars FROM m_facts GROUP BY 1)
       ON pid = p_partkey""",
    "m_customers": "SELECT c_custkey AS customer_id, c_name AS customer_name FROM customer",
    "m_orders": """
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
       CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount, o_orderdate AS order_date
FROM orders""",
    "m_lines": """
SELECT l_orderkey AS order_id, l_linenumber AS line_no, max(l_partkey) AS product_id,
       max(CAST(l_quantity AS INTEGER)) AS quantity,
       max(CAST(l_extendedprice AS DECIMAL(12,2))) AS unit_price
FROM lineitem GROUP BY 1, 2""",
    "m_crawl": """
SELECT n_nationkey AS category_id, n_name AS category_name,
       'https://shop.example/c' || n_nationkey AS category_url, n_regionkey AS parent_category_id,
       n_nationkey % 7 <> 0 AS is_active,
       CASE WHEN n_nationkey % 13 <> 0 THEN n_nationkey % 11 END AS priority,
       n_nationkey * 5 % 60 + 1 AS max_pages,
       list_extract(['pending', 'in_progress', 'completed', 'failed', 'paused'], n_nationkey % 5 + 1) AS crawl_status,
       CASE WHEN n_nationkey % 3 <> 0 THEN TIMESTAMP '2024-01-01' + to_days(n_nationkey) END AS last_crawled_at,
       n_nationkey % 4 AS last_crawled_page, n_nationkey * 10 AS total_products_crawled,
       CASE WHEN n_nationkey % 5 = 3 THEN 'Error: ' || n_name END AS notes
FROM nation""",
    "m_logs": """
SELECT event_id AS log_id, 'listing_cat_' || user_id AS crawler_type,
       CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'running' ELSE 'completed' END AS status,
       CAST(props ->> '$.k' AS INTEGER) AS items_crawled,
       'Last page: ' || (props ->> '$.k') AS error_message, ts AS started_at,
       CASE WHEN event_type <> 'signup' THEN ts + to_seconds(CAST(props ->> '$.k' AS INTEGER)) END AS completed_at
FROM events""",
    "m_summary": """
SELECT p.product_id, any_value(p.name) AS name, count(r.review_id) AS total_reviews,
       count(CASE WHEN sentiment = 'positive' THEN 1 END) AS positive_count,
       count(CASE WHEN sentiment = 'negative' THEN 1 END) AS negative_count,
       count(CASE WHEN sentiment = 'neutral' THEN 1 END) AS neutral_count,
       sum(confidence_10k) AS confidence_sum, count(confidence_10k) AS confidence_n
FROM m_products p
LEFT JOIN m_facts r ON p.product_id = r.product_id
LEFT JOIN m_sentiment s ON r.review_id = s.review_id
GROUP BY p.product_id""",
}

PRICE_NOW = "(SELECT max(l_shipdate) FROM lineitem)"
REVIEW_NOW = "(SELECT max(ts) FROM events)"


def needed(text: str) -> list[str]:
    """Model tables a text uses, directly or not, in definition order."""
    found: set[str] = set()
    todo = [text]
    while todo:
        for name in set(re.findall(r"\bm_[a-z]+\b", todo.pop())) - found:
            if name in MODEL:
                found.add(name)
                todo.append(MODEL[name])
    return [n for n in MODEL if n in found]


def with_model(body: str) -> str:
    tables = needed(body)
    ctes = ",\n".join(f"{n} AS ({MODEL[n]})" for n in tables)
    if not tables:
        return body
    if body.lstrip().upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes},\n{body.lstrip()[15:]}"
    if body.lstrip().upper().startswith("WITH "):
        return f"WITH {ctes},\n{body.lstrip()[5:]}"
    return f"WITH {ctes}\n{body}"


def ts(expr: str, name: str | None = None) -> str:
    """A time as text with microseconds."""
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f') AS {name or expr}"


def day(expr: str, name: str | None = None) -> str:
    return f"strftime({expr}, '%Y-%m-%d') AS {name or expr}"


def dbl(expr: str, name: str | None = None) -> str:
    return f"CAST({expr} AS DOUBLE) AS {name or expr}"
