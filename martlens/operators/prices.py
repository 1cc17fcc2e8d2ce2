"""Price history: changes, rollups, refresh, retention and gap-filled series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from martlens.functions import ordered, scalars as X


def since(as_of: Column, days: int) -> Column:
    return as_of - F.make_dt_interval(days=F.lit(days))


def price_changes(
    products: DataFrame,
    prices: DataFrame,
    as_of: Column,
    days: int = 7,
    order: str = "reference",
    slice_width: str = "hour",
) -> DataFrame:
    """Rows whose price differs from the neighbouring row of the same product.

    order="reference" compares with the row that follows in time, as a lag over a descending
    order does; order="chronological" compares with the row before.  The period filter comes
    first, so rows outside it are no neighbours.  A hot product is cut into slices of time.
    """
    if order not in ("reference", "chronological"):
        raise ValueError("order must be 'reference' or 'chronological'")
    recent = prices.select("product_id", "price", "timestamp").filter(
        F.col("timestamp") >= since(as_of, days)
    )
    compared = ordered.with_neighbour(
        recent,
        ["product_id"],
        "timestamp",
        ["price", "timestamp"],
        F.date_trunc(slice_width, "timestamp"),
        towards="previous" if order == "chronological" else "next",
    )
    changed = compared.filter(
        F.col("previous_price").isNotNull() & (F.col("price") != F.col("previous_price"))
    )
    difference = F.col("price") - F.col("previous_price")
    names = products.select("product_id", "name")
    return changed.join(names, "product_id").select(
        "product_id",
        "name",
        F.col("price").alias("current_price"),
        "previous_price",
        difference.alias("price_difference"),
        X.ratio(difference, F.col("previous_price")).alias("price_change_percent"),
        F.col("timestamp").alias("current_timestamp"),
        "previous_timestamp",
    )


def largest_changes(changes: DataFrame, n: int) -> DataFrame:
    return changes.orderBy(
        F.desc(F.abs("price_difference")), "product_id", "current_timestamp"
    ).limit(n)


def hourly_rollup(prices: DataFrame, width: str = "1 hour") -> DataFrame:
    """Mean, lowest, highest price and number of rows per product and time bucket."""
    per_window = prices.groupBy("product_id", F.window("timestamp", width).alias("w")).agg(
        X.mean(F.sum("price"), F.count("price")).alias("avg_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.count("*").alias("price_changes"),
    )
    values = ("avg_price", "min_price", "max_price", "price_changes")
    return per_window.select("product_id", F.col("w.start").alias("bucket"), *values)


def price_states(prices: DataFrame) -> DataFrame:
    """What an hour's prices of a product come to, in a form that adds up: sum, count, lowest and highest."""
    return prices.groupBy("product_id", F.date_trunc("hour", "timestamp").alias("bucket")).agg(
        F.sum("price").alias("total"), F.count("price").alias("n"), F.min("price").alias("low"), F.max("price").alias("high"), F.count("*").alias("changes")
    )


def coarser_states(states: DataFrame, unit: str) -> DataFrame:
    """States of days, weeks or months from those of hours; no price is read again."""
    return states.groupBy("product_id", F.date_trunc(unit, "bucket").alias("bucket")).agg(
        F.sum("total").alias("total"), F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("changes").alias("changes")
    )


def rollup_of(states: DataFrame) -> DataFrame:
    """The rollup that states stand for, as `hourly_rollup` has it."""
    return states.select(
        "product_id", "bucket", X.mean(F.col("total"), F.col("n")).alias("avg_price"),
        F.col("low").alias("min_price"), F.col("high").alias("max_price"), F.col("changes").alias("price_changes"),
    )


def refresh_range(as_of: Column, start_days: int = 3, end_hours: int = 1) -> tuple[Column, Column]:
    """First and last moment of the buckets a refresh rebuilds; both on bucket borders."""
    low = F.date_trunc("hour", as_of - F.make_dt_interval(days=F.lit(start_days)))
    exact = low == as_of - F.make_dt_interval(days=F.lit(start_days))
    low = F.when(exact, low).otherwise(low + F.make_dt_interval(hours=F.lit(1)))
    high = F.date_trunc("hour", as_of - F.make_dt_interval(hours=F.lit(end_hours)))
    return low, high


def refresh_rollup(
    rollup: DataFrame, prices: DataFrame, as_of: Column, start_days: int = 3, end_hours: int = 1
) -> DataFrame:
    """Rebuild the buckets that lie wholly in the refresh range and keep all others.

    Rows that arrive later than the range reaches back never change the rollup.
    """
    low, high = refresh_range(as_of, start_days, end_hours)
    inside = (F.col("bucket") >= low) & (F.col("bucket") < high)
    changed = prices.filter((F.col("timestamp") >= low) & (F.col("timestamp") < high))
    return rollup.filter(~inside).unionByName(hourly_rollup(changed))


def retained(prices: DataFrame, as_of: Column, days: int = 90) -> DataFrame:
    """Price rows young enough to keep."""
    return prices.filter(F.col("timestamp") >= since(as_of, days))


def filled_series(prices: DataFrame, unit: str = "day") -> DataFrame:
    """One row per product and calendar unit from its first to its last price, gaps filled forward.

    Prices are reduced to the last one per unit first, so a series is as long as its time span,
    however many rows a product has.
    """
    period = F.date_trunc(unit, "timestamp").alias("period")
    known = prices.groupBy("product_id", period).agg(F.max_by("price", "timestamp").alias("close"))
    spans = known.groupBy("product_id").agg(F.min("period").alias("lo"), F.max("period").alias("hi"))
    step = F.expr(f"INTERVAL 1 {unit}")
    periods = spans.select("product_id", F.explode(F.sequence("lo", "hi", step)).alias("period"))
    upto = Window.partitionBy("product_id").orderBy("period")
    return periods.join(known, ["product_id", "period"], "left").select(
        "product_id",
        "period",
        F.last("close", ignorenulls=True).over(upto).alias("price"),
        F.col("close").isNull().alias("filled"),
    )


def product_history(prices: DataFrame) -> DataFrame:
    """Price rows of every product in time order."""
    return prices.select("product_id", "timestamp", "price", "discount_percent").orderBy(
        "product_id", "timestamp"
    )


def fluctuation(prices: DataFrame) -> DataFrame:
    """Volatility per product: relative standard deviation and relative span of its prices."""
    as_number = F.col("price").cast("double")
    return prices.groupBy("product_id").agg(
        F.count("*").alias("n_prices"),
        F.round(F.stddev_samp(as_number) / F.nullif(F.avg(as_number), F.lit(0.0)), 4).alias("volatility"),
        X.ratio(F.max("price") - F.min("price"), F.min("price"), 4, 1).alias("span"),
    )


def price_trend(prices: DataFrame, unit: str = "month") -> DataFrame:
    """Mean price over all products per calendar unit."""
    return prices.groupBy(F.date_trunc(unit, "timestamp").alias("period")).agg(
        X.mean(F.sum("price"), F.count("price")).alias("avg_price"), F.count("*").alias("n_prices")
    )
