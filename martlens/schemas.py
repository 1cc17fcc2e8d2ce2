"""Explicit schemas of every table, message and payload, as Spark DDL.

Decimals keep money exact; every time is a TIMESTAMP read in UTC.
"""

TABLES = {
    "categories": "category_id INT, category_name STRING, parent_id INT, created_at TIMESTAMP",
    "shops": (
        "shop_id BIGINT, shop_name STRING, rating DECIMAL(3,2), response_rate INT, "
        "follower_count INT, is_official BOOLEAN, created_at TIMESTAMP, last_updated TIMESTAMP"
    ),
    "products": (
        "product_id BIGINT, name STRING, shop_id BIGINT, category_id INT, url STRING, "
        "image_url STRING, description STRING, rating DECIMAL(3,2), sold_count INT, "
        "first_seen TIMESTAMP, last_updated TIMESTAMP, review_count INT, discount_rate INT, "
        "short_description STRING, authors STRING, specifications STRING, "
        "configurable_options STRING"
    ),
    "product_prices": (
        "product_id BIGINT, price DECIMAL(12,2), original_price DECIMAL(12,2), "
        "discount_percent INT, stock_available INT, timestamp TIMESTAMP"
    ),
    "reviews": (
        "review_id BIGINT, product_id BIGINT, user_name STRING, rating INT, comment STRING, "
        "has_images BOOLEAN, helpful_count INT, created_at TIMESTAMP, crawled_at TIMESTAMP"
    ),
    "review_sentiment": (
        "review_id BIGINT, sentiment STRING, confidence_score DECIMAL(5,4), processed_at TIMESTAMP"
    ),
    "crawl_logs": (
        "log_id BIGINT, crawler_type STRING, status STRING, items_crawled INT, errors_count INT, "
        "error_message STRING, started_at TIMESTAMP, completed_at TIMESTAMP, duration_seconds INT"
    ),
    "customers": (
        "customer_id BIGINT, customer_name STRING, email STRING, phone STRING, address STRING, "
        "created_at TIMESTAMP, last_updated TIMESTAMP"
    ),
    "orders": (
        "order_id BIGINT, customer_id BIGINT, review_id BIGINT, order_date TIMESTAMP, "
        "total_amount DECIMAL(12,2), status STRING, created_at TIMESTAMP"
    ),
    "order_lines": (
        "order_line_id BIGINT, order_id BIGINT, product_id BIGINT, quantity INT, "
        "unit_price DECIMAL(12,2), subtotal DECIMAL(12,2), created_at TIMESTAMP"
    ),
    "crawl_categories": (
        "category_id INT, category_name STRING, category_url STRING, parent_category_id INT, "
        "is_active BOOLEAN, priority INT, max_pages INT, crawl_status STRING, "
        "last_crawled_at TIMESTAMP, last_crawled_page INT, total_products_crawled INT, "
        "notes STRING, created_at TIMESTAMP, updated_at TIMESTAMP"
    ),
}

# Payloads as they arrive.  Page elements stay raw JSON text so that a key that is
# absent can still be told from a key that is null.
PAGE = "data ARRAY<STRING>, paging STRUCT<total: INT, last_page: INT, current_page: INT>"

LISTING_ITEM = (
    "id BIGINT, name STRING, url_path STRING, thumbnail_url STRING, short_description STRING, "
    "seller STRUCT<id: BIGINT, name: STRING>, seller_id BIGINT, primary_category_path STRING, "
    "rating_average DOUBLE, quantity_sold STRUCT<value: INT>, price DOUBLE, "
    "original_price DOUBLE, discount_rate INT, availability INT, "
    "visible_impression_info STRUCT<amplitude: STRUCT<seller_type: STRING>>"
)

CATALOG_ITEM = (
    "id BIGINT, name STRING, url_path STRING, thumbnail_url STRING, short_description STRING, "
    "seller STRUCT<id: BIGINT, name: STRING, is_best_store: BOOLEAN>, "
    "categories STRUCT<id: INT>, rating_average DOUBLE, quantity_sold STRUCT<value: INT>, "
    "price DOUBLE, original_price DOUBLE, discount_rate INT, stock_item STRUCT<qty: INT>"
)

PRODUCT_DETAIL = (
    "id BIGINT, name STRING, short_url STRING, url_path STRING, thumbnail_url STRING, "
    "short_description STRING, description STRING, rating_average DOUBLE, review_count INT, "
    "discount_rate INT, all_time_quantity_sold INT, quantity_sold STRUCT<value: INT>, "
    "categories STRUCT<id: INT>, current_seller STRUCT<id: BIGINT, name: STRING>, "
    "authors ARRAY<STRUCT<id: BIGINT, name: STRING, slug: STRING>>, "
    "specifications ARRAY<STRUCT<name: STRING, "
    "attributes: ARRAY<STRUCT<code: STRING, name: STRING, value: STRING>>>>, "
    "configurable_options ARRAY<STRUCT<code: STRING, name: STRING, position: INT, "
    "values: ARRAY<STRUCT<label: STRING>>>>, spid BIGINT"
)

REVIEW_DETAIL = (
    "id BIGINT, product_id BIGINT, title STRING, content STRING, thank_count INT, rating INT, "
    "images ARRAY<STRUCT<id: BIGINT>>, created_at STRING, "
    "created_by STRUCT<id: BIGINT, name: STRING, full_name: STRING>"
)

REVIEW_STARS = "stars MAP<STRING, STRUCT<count: INT, percent: INT>>"

PRODUCT_MESSAGE = (
    "item_type STRING, product_id BIGINT, name STRING, url STRING, image_url STRING, "
    "description STRING, shop_id BIGINT, category_id INT, rating DOUBLE, sold_count INT, "
    "price DECIMAL(12,2), original_price DECIMAL(12,2), discount_percent INT, "
    "stock_available INT, spid BIGINT, crawled_at STRING, kafka_timestamp STRING"
)

SHOP_MESSAGE = (
    "item_type STRING, shop_id BIGINT, shop_name STRING, rating DECIMAL(3,2), "
    "response_rate INT, follower_count INT, is_official BOOLEAN, crawled_at STRING"
)

ORDER_MESSAGE = (
    "review_id BIGINT, product_id BIGINT, customer_id BIGINT, customer_name STRING, "
    "order_date STRING, rating INT"
)

SENTIMENT_MESSAGE = (
    "review_id BIGINT, product_id BIGINT, comment STRING, rating INT, created_at STRING"
)

DETAIL_REQUEST = "product_id BIGINT, spid BIGINT"
REVIEW_REQUEST = "product_id BIGINT, spid BIGINT, seller_id BIGINT"

# The labels and states the tables accept.
SENTIMENTS = ("positive", "negative", "neutral")
CRAWL_STATES = ("pending", "in_progress", "completed", "failed", "paused")

# Topic of each item type and of each stage.
ITEM_TOPICS = {"product": "products", "review": "reviews", "shop": "shops"}
STAGE_TOPICS = ("product-detail", "review-fetch", "review-detail", "orders", "sentiment-analysis")
