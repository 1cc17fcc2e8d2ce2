"""Crawl bookkeeping: the work queue, its state changes and the run log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martlens.functions import ordered, scalars as X
from martlens.operators import merge


def work_list(categories: DataFrame, status: str | None = None, limit: int | None = None) -> DataFrame:
    """Active categories to crawl: one status, or pending and failed ones; best priority first."""
    wanted = [status] if status else ["pending", "failed"]
    rows = categories.filter(F.col("is_active") & F.col("crawl_status").isin(*wanted)).orderBy(
        F.desc_nulls_first("priority"), "category_id"
    )
    return rows if limit is None else rows.limit(limit)


def next_category(categories: DataFrame) -> DataFrame:
    """The category to crawl next: pending or failed by priority, else the stalest completed one."""
    fresh = F.col("crawl_status").isin("pending", "failed")
    able = categories.filter(
        F.col("is_active") & F.col("crawl_status").isin("pending", "failed", "completed")
    )
    return able.orderBy(
        F.when(fresh, 0).otherwise(1),
        F.asc_nulls_first(F.when(~fresh, F.col("last_crawled_at"))),
        F.desc_nulls_first("priority"),
        "category_id",
    ).limit(1)


def next_pending(categories: DataFrame) -> DataFrame:
    return work_list(categories, "pending", 1)


def listing(categories: DataFrame, status: str | None = None, active_only: bool = False) -> DataFrame:
    rows = categories
    if status:
        rows = rows.filter(F.col("crawl_status") == status)
    if active_only:
        rows = rows.filter("is_active")
    return rows.orderBy(F.desc_nulls_first("priority"), "category_id")


def failed(categories: DataFrame) -> DataFrame:
    return categories.filter(F.col("crawl_status") == "failed").select("category_id", "category_name", "notes")


def status_counts(categories: DataFrame) -> DataFrame:
    state = F.col("crawl_status")
    return categories.agg(
        F.count("*").alias("total"),
        F.count_if("is_active").alias("active"),
        *[F.count_if(state == s).alias(s) for s in ("pending", "in_progress", "completed", "failed")],
        F.coalesce(F.sum("total_products_crawled"), F.lit(0)).alias("total_products"),
    )


def crawl_totals(categories: DataFrame) -> DataFrame:
    return categories.filter("is_active").agg(
        F.sum("total_products_crawled").alias("total_products"),
        F.count("*").alias("total_categories"),
        F.count_if(F.col("crawl_status") == "completed").alias("completed_categories"),
    )


# Columns an action sets.  `set` actions name theirs in `fields`.
ACTION_FIELDS = {
    "activate": ["is_active"],
    "deactivate": ["is_active"],
    "reset": ["crawl_status", "last_crawled_page", "total_products_crawled", "last_crawled_at"],
    "status": ["crawl_status", "last_crawled_at"],
    "status_error": ["crawl_status", "last_crawled_at", "notes"],
}


def category_updates(actions: DataFrame) -> DataFrame:
    """Actions (category_id, seq, action, at, status, message) to update rows for `apply_actions`."""
    action = F.col("action")
    has_error = (action == "status") & F.col("message").isNotNull()
    kind = F.when(has_error, "status_error").otherwise(action)
    fields = F.create_map(
        *[x for k, v in ACTION_FIELDS.items() for x in (F.lit(k), F.array(*[F.lit(f) for f in v]))]
    )
    return actions.select(
        "category_id",
        "seq",
        F.try_element_at(fields, kind).alias("present"),
        F.when(action == "activate", True).when(action == "deactivate", False).alias("is_active"),
        F.when(action == "reset", "pending").otherwise(F.col("status")).alias("crawl_status"),
        F.when(action == "reset", 0).alias("last_crawled_page"),
        F.when(action == "reset", 0).alias("total_products_crawled"),
        F.when(action == "status", F.col("at")).alias("last_crawled_at"),
        F.concat(F.lit("Error: "), "message").alias("notes"),
    )


UPDATABLE = (
    "is_active",
    "crawl_status",
    "last_crawled_page",
    "total_products_crawled",
    "last_crawled_at",
    "notes",
)


def apply_actions(categories: DataFrame, actions: DataFrame, as_of: Column) -> DataFrame:
    """Apply queue actions in `seq` order; unknown category ids change nothing."""
    return merge.merge_rows(
        categories,
        category_updates(actions),
        "category_id",
        [c for c in UPDATABLE if c in categories.columns],
        policy="present",
        as_of=as_of,
        touched="updated_at" if "updated_at" in categories.columns else None,
        insert=False,
        touch_always=False,
    )


def add_categories(categories: DataFrame, new: DataFrame) -> DataFrame:
    """Add categories whose id is new, as active and pending; existing ids are left alone."""
    rows = new.withColumns({"is_active": F.lit(True), "crawl_status": F.lit("pending")})
    return merge.insert_ignore(categories, rows, "category_id")


def resume_pages(logs: DataFrame) -> DataFrame:
    """The page each crawler starts at: one after the page its latest usable run noted."""
    usable = logs.filter(F.col("status").isin("running", "completed"))
    latest = usable.groupBy("crawler_type").agg(
        F.max_by("error_message", F.struct("started_at", "log_id")).alias("note")
    )
    page = F.coalesce(X.page_from_note("note"), F.lit(0))
    return latest.select("crawler_type", page.alias("last_page"), (page + 1).alias("start_page"))


def request_grid(ids: DataFrame, id_column: str, start: Column, max_pages: Column) -> DataFrame:
    """The pages to request for each id: `max_pages` of them from `start` on."""
    none = F.array().cast("array<int>")
    pages = F.when(max_pages > 0, F.sequence(start.cast("int"), (start + max_pages - 1).cast("int")))
    return ids.select(id_column, F.explode(F.coalesce(pages, none)).alias("page"))


def missing_pages(landed: DataFrame, key: str) -> DataFrame:
    """Pages a payload's own `last_page` announces but that have not landed."""
    ends = landed.groupBy(key).agg(F.max_by("last_page", F.when(F.col("page") == 1, 1)).alias("last_page"))
    last = F.greatest(F.coalesce("last_page", F.lit(1)), F.lit(1))
    expected = ends.select(key, F.explode(F.sequence(F.lit(1), last)).alias("page"))
    return expected.join(landed.select(key, "page"), [key, "page"], "left_anti")


def run_log(events: DataFrame) -> DataFrame:
    """Run events (run_id, seq, kind, at, items, page, message, reason) to one row per run.

    Events are start, page, error and close.  The note a run ends with is its last page line
    followed by the errors after it; the errors are rows of `run_messages`, because a run
    may log any number of them.
    """
    kind = F.col("kind")
    pages = kind.isin("start", "page")
    folded = events.groupBy("run_id").agg(
        F.coalesce(F.sum(F.when(kind == "page", F.col("items"))), F.lit(0)).alias("items_crawled"),
        F.count_if(kind == "error").alias("errors_count"),
        F.max_by("page", F.when(pages, F.col("seq"))).alias("last_page"),
        F.min(F.when(kind == "start", F.col("at"))).alias("started_at"),
        F.max(F.when(kind == "close", F.col("at"))).alias("completed_at"),
        F.max_by(F.col("reason") == "finished", F.when(kind == "close", F.col("seq"))).alias("finished"),
    )
    closed = F.col("completed_at").isNotNull()
    status = F.when(~closed, "running").when(F.col("finished"), "completed").otherwise("failed")
    return folded.select(
        "run_id",
        status.alias("status"),
        "items_crawled",
        "errors_count",
        F.concat(F.lit("Last page: "), F.coalesce("last_page", F.lit(0))).alias("page_note"),
        "started_at",
        "completed_at",
        F.floor(X.seconds_between("started_at", "completed_at")).cast("bigint").alias("duration_seconds"),
    )


def run_messages(events: DataFrame) -> DataFrame:
    """The error lines each run's note ends with, numbered in order."""
    kind = F.col("kind")
    last_page = events.filter(kind.isin("start", "page")).groupBy("run_id").agg(F.max("seq").alias("_page_seq"))
    errors = events.filter(kind == "error").join(last_page, "run_id", "left")
    kept = errors.filter(F.col("seq") > F.coalesce("_page_seq", F.lit(-1)))
    numbered = ordered.with_row_number(kept.select("run_id", "seq", "message"), ["run_id"], "seq", "line_no")
    return numbered.select("run_id", "line_no", "message")


def hourly_activity(logs: DataFrame) -> DataFrame:
    """Runs, success rate and items per hour."""
    done = F.count_if(F.col("status") == "completed")
    ended = F.count_if(F.col("status").isin("completed", "failed"))
    return logs.groupBy(X.hour_of("started_at").alias("hour")).agg(
        F.count("*").alias("runs"),
        X.ratio(done, ended).alias("success_percent"),
        F.sum("items_crawled").alias("items"),
    )


def hourly_arrivals(rows: DataFrame, time: str, out: str) -> DataFrame:
    return rows.groupBy(X.hour_of(time).alias("hour")).agg(F.count("*").alias(out))


def freshness(logs: DataFrame, as_of: Column) -> DataFrame:
    """Seconds since each crawler last started."""
    last = logs.groupBy("crawler_type").agg(F.max("started_at").alias("last_started"))
    age = F.floor(X.seconds_between(F.col("last_started"), as_of)).cast("bigint")
    return last.select("crawler_type", "last_started", age.alias("age_seconds"))


def run_durations(logs: DataFrame) -> DataFrame:
    seconds = F.floor(X.seconds_between("started_at", "completed_at")).cast("bigint")
    return logs.select("log_id", "status", seconds.alias("duration_seconds"))
