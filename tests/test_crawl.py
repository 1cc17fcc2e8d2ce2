"""The manual checklist of the work queue, and the run log."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from martlens.operators import crawl as C

# id, parent, priority, pages: an invented tree of kitchen goods with ties and one unset priority among the leaves
SEEDS = [
    (100, None, 5, 20), (110, 100, 7, 12), (120, 100, 7, 12), (200, None, 3, 9), (210, 200, 3, 6), (211, 210, 1, 4),
    (300, None, 2, 2),
]
COLUMNS = (
    "category_id int, parent_category_id int, priority int, max_pages int, is_active boolean, crawl_status string, "
    "last_crawled_at timestamp, last_crawled_page int, total_products_crawled int, notes string"
)
ACTION = "category_id int, seq bigint, action string, at timestamp, status string, message string"


@pytest.fixture
def queue(spark):
    rows = spark.createDataFrame([(*s, True, "pending", None, 3, 30, None) for s in SEEDS], COLUMNS)
    return rows.withColumn("category_name", F.concat(F.lit("category "), "category_id"))


def act(spark, queue, *actions):
    rows = [(c, i, a, None, s, m) for i, (c, a, s, m) in enumerate(actions)]
    df = spark.createDataFrame(rows, ACTION).withColumn("at", F.lit("2024-03-01").cast("timestamp"))
    return C.apply_actions(queue, df, F.lit("2024-03-01").cast("timestamp"))


def test_seeds(queue):
    assert queue.count() == 7
    assert C.next_category(queue).first().category_id == 110  # of equal priorities the smaller id
    assert C.next_pending(queue).first().category_id == 110
    assert C.status_counts(queue).first().pending == 7


def test_adding_twice_and_new(spark, queue):
    new = spark.createDataFrame([(110, 1), (400, 2)], "category_id int, priority int")
    got = {r.category_id: r for r in C.add_categories(queue, new).collect()}
    assert len(got) == 8 and got[110].priority == 7
    assert (got[400].crawl_status, got[400].is_active) == ("pending", True)


def test_actions(spark, queue):
    moved = act(
        spark,
        queue,
        (110, "status", "completed", None),
        (120, "status", "failed", "timeout"),
        (100, "deactivate", None, None),
        (110, "reset", None, None),
        (210, "status", "completed", None),
        (100, "activate", None, None),
        (300, "deactivate", None, None),
        (999, "reset", None, None),
    )
    rows = {r.category_id: r for r in moved.collect()}
    assert len(rows) == 7
    r = rows[110]
    assert (r.crawl_status, r.last_crawled_page, r.total_products_crawled, r.last_crawled_at) == ("pending", 0, 0, None)
    assert (rows[120].crawl_status, rows[120].notes) == ("failed", "Error: timeout")
    assert rows[100].is_active and not rows[300].is_active
    assert rows[210].notes is None and rows[210].last_crawled_at is not None
    assert C.next_category(moved).first().category_id == 110
    assert [r.category_id for r in C.failed(moved).collect()] == [120]


def test_completed_are_repeated_when_nothing_else_is_left(spark, queue):
    # crawled the later, the smaller the id; 211 was never crawled
    crawled = F.timestamp_add("DAY", -F.col("category_id"), F.lit("2024-01-01").cast("timestamp"))
    done = queue.withColumn("crawl_status", F.lit("completed")).withColumn(
        "last_crawled_at", F.when(F.col("category_id") != 211, crawled)
    )
    assert C.next_category(done).first().category_id == 211  # never crawled comes first
    assert C.next_category(done.filter("category_id != 211")).first().category_id == 300
    assert C.next_category(done.limit(0)).count() == 0


def test_null_priority_comes_first_as_in_the_store(spark, queue):
    with_null = queue.withColumn("priority", F.when(F.col("category_id") != 211, F.col("priority")))
    assert C.next_pending(with_null).first().category_id == 211


def test_resume_page(spark):
    rows = [
        (1, "a", "completed", "Last page: 4", "2024-01-01"), (2, "a", "running", "Last page: 9\nboom", "2024-01-02"),
        (3, "a", "failed", "Last page: 50", "2024-01-03"), (4, "b", "completed", None, "2024-01-01"),
        (5, "c", "failed", "Last page: 3", "2024-01-01"),
    ]
    logs = spark.createDataFrame(rows, "log_id bigint, crawler_type string, status string, error_message string, s string")
    logs = logs.withColumn("started_at", F.col("s").cast("timestamp"))
    got = {r.crawler_type: r.start_page for r in C.resume_pages(logs).collect()}
    assert got == {"a": 10, "b": 1}


def test_run_log(spark):
    t = "2024-01-01 00:00:"
    rows = [
        (1, 0, "start", t + "00", None, 0, None, None), (1, 1, "page", t + "05", 10, 1, None, None),
        (1, 2, "error", t + "06", None, None, "old", None), (1, 3, "page", t + "07", 7, 2, None, None),
        (1, 4, "error", t + "08", None, None, "x", None), (1, 5, "error", t + "09", None, None, "y", None),
        (1, 6, "close", t + "10", None, None, None, "finished"), (2, 0, "start", t + "00", None, 4, None, None),
        (3, 0, "start", t + "00", None, 0, None, None), (3, 1, "close", t + "01", None, None, None, "shutdown"),
    ]
    names = "run_id int, seq bigint, kind string, t string, items int, page int, message string, reason string"
    events = spark.createDataFrame(rows, names).withColumn("at", F.col("t").cast("timestamp"))
    got = {r.run_id: r for r in C.run_log(events).collect()}
    one = got[1]
    assert (one.status, one.items_crawled, one.errors_count, one.page_note, one.duration_seconds) == (
        "completed", 17, 3, "Last page: 2", 10,
    )
    assert (got[2].status, got[2].page_note, got[2].duration_seconds) == ("running", "Last page: 4", None)
    assert got[3].status == "failed"
    lines = sorted(map(tuple, C.run_messages(events).collect()))
    assert lines == [(1, 1, "x"), (1, 2, "y")]


def test_request_grid_and_missing_pages(spark):
    df = spark.createDataFrame([(1, 3, 2), (2, 1, 0)], "id int, start int, n int")
    grid = C.request_grid(df, "id", F.col("start"), F.col("n"))
    assert sorted(map(tuple, grid.collect())) == [(1, 3), (1, 4)]
    landed = spark.createDataFrame([("a", 1, 3), ("a", 3, 3), ("b", 2, 5)], "k string, page int, last_page int")
    assert sorted(map(tuple, C.missing_pages(landed, "k").collect())) == [("a", 2), ("b", 1)]
