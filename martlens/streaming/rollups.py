"""Streaming aggregates and duplicate removal with bounded state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from martlens.operators import merge, prices as P
from martlens.sources import files
from martlens.sources.tables import LogTable


def hourly_rollup_stream(stream: DataFrame, lateness: str = "3 days") -> DataFrame:
    """The hourly price rollup as a stream.

    A bucket is emitted once, when it is older than the watermark; rows later than that change
    nothing, and their state is gone.
    """
    return P.hourly_rollup(stream.withWatermark("timestamp", lateness))


def first_seen_stream(stream: DataFrame, key: str, time: str, within: str = "3 days") -> DataFrame:
    """The first row of each key; state is kept only as long as copies may still come."""
    return stream.withWatermark(time, within).dropDuplicatesWithinWatermark([key])


def store_first(stream: DataFrame, table: LogTable, source: str, order: str, checkpoint: str) -> None:
    """Append the first row of each key to a keyed table, whenever its copies come: a batch looks its keys up among all
    stored rows, reading only the folders they fall into."""

    def store(batch: DataFrame, batch_id: int) -> None:
        table.settle(source, batch_id)
        batch = batch.persist()
        table.append(merge.new_rows(batch, table.log(batch, before=(source, batch_id)), table.key, order), source, batch_id)
        batch.unpersist()

    stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def throughput(rows: DataFrame, time: str, width: str = "1 hour") -> DataFrame:
    """Messages and messages per second in each time window."""
    w = F.window(time, width)
    counted = rows.groupBy(w.alias("w")).agg(F.count("*").alias("messages"))
    seconds = F.unix_micros(F.col("w.end")) / 1e6 - F.unix_micros(F.col("w.start")) / 1e6
    return counted.select(
        F.col("w.start").alias("window_start"),
        "messages",
        F.round(F.col("messages") / seconds, 6).alias("per_second"),
    )


def write_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write all that is available to Parquet, exactly once per checkpoint, and stop."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def write_rollup(rollup: DataFrame, path: str, unit: str = "day", mode: str = "static") -> None:
    """Store a rollup in one partition per calendar unit; mode="dynamic" replaces only those it has.

    Rows are rebalanced by period: AQE splits a period that holds most of them and merges small ones.
    """
    (
        rollup.withColumn("bucket_period", F.to_date(F.date_trunc(unit, "bucket")))
        .hint("rebalance", F.col("bucket_period"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy("bucket_period")
        .parquet(path)
    )


def refresh_stored(prices_df: DataFrame, path: str, as_of: Column, unit: str = "day", **offsets) -> None:
    """The incremental refresh on disk.

    Only the partitions the refresh range touches are read and rewritten; a partition that the
    range covers in part keeps its other buckets.  A partition that comes out empty is removed before the write, which by
    itself only replaces partitions that still have rows; after a crash between the two, the refresh is made again.
    """
    low, high = P.refresh_range(as_of, **offsets)
    first, last = F.date_trunc(unit, low), F.date_trunc(unit, high)
    stored = prices_df.sparkSession.read.parquet(path)
    in_reach = (F.col("bucket_period") >= first) & (F.col("bucket_period") <= last)
    touched = stored.filter(in_reach).drop("bucket_period")
    fresh = P.refresh_rollup(touched, prices_df, as_of, **offsets)
    period = F.to_date(F.date_trunc(unit, "bucket")).alias("bucket_period")
    # no more rows than the range has periods
    emptied = touched.select(period).distinct().exceptAll(fresh.select(period).distinct())
    gone = [row.bucket_period for row in emptied.toLocalIterator()]
    for day in gone:
        files.remove(prices_df.sparkSession, f"{path}/bucket_period={day}")
    kept = stored.filter(in_reach & ~F.col("bucket_period").isin(gone)).drop("bucket_period")
    write_rollup(P.refresh_rollup(kept, prices_df, as_of, **offsets), path, unit, mode="dynamic")


class StoredRollup:
    """Prices and the hourly states made of them, both in one folder per calendar unit.

    A batch of prices adds its own folder, so the folders themselves are the log of what changed: a refresh reads
    the prices of the units that its batches touched, however old they are, and rebuilds the states of these units only.  Of
    several prices of a product and time the latest batch's counts; a null price withdraws it.  Days, weeks and months
    are added up from the stored hours.  Both steps can be repeated after a crash.
    """

    PRICES = "product_id BIGINT, price DECIMAL(12,2), timestamp TIMESTAMP, batch_id BIGINT, period DATE"
    STATES = "product_id BIGINT, bucket TIMESTAMP, total DECIMAL(22,2), n BIGINT, low DECIMAL(12,2), high DECIMAL(12,2), changes BIGINT, period DATE"

    def __init__(self, spark: SparkSession, root: str, unit: str = "day"):
        self.spark, self.root, self.unit = spark, root, unit

    def _dealt(self, rows: DataFrame, time: str) -> DataFrame:
        return rows.withColumn("period", F.to_date(F.date_trunc(self.unit, time))).hint("rebalance", F.col("period"))

    def add(self, rows: DataFrame, batch_id: int) -> None:
        typed = self._dealt(rows.select("product_id", "price", "timestamp"), "timestamp")
        typed.write.mode("overwrite").partitionBy("period").parquet(f"{self.root}/prices/batch_id={batch_id}")

    def changed(self, since: int, upto: int) -> DataFrame:
        """The prices of all units that batches after `since` up to `upto` touched: a filter on folders."""
        prices = self.spark.read.schema(self.PRICES).parquet(f"{self.root}/prices")
        touched = prices.where((F.col("batch_id") > since) & (F.col("batch_id") <= upto)).select("period").distinct()
        # one row for each calendar unit
        units = [row.period for row in touched.toLocalIterator()]
        return prices.where(F.col("period").isin(units) & (F.col("batch_id") <= upto))

    def refresh(self, since: int, upto: int) -> None:
        prices = self.changed(since, upto)
        newest = prices.groupBy("product_id", "timestamp").agg(F.max_by("price", "batch_id").alias("price")).where("price is not null")
        seen = Observation("periods")
        # one value for each calendar unit
        states = self._dealt(P.price_states(newest), "bucket").observe(seen, F.collect_set("period").alias("left"))
        states.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period").parquet(f"{self.root}/states")
        left = set(seen.get.get("left") or ())
        for row in prices.select("period").distinct().toLocalIterator():
            if row.period not in left:
                files.remove(self.spark, f"{self.root}/states/period={row.period}")

    def rollup(self, unit: str = "hour") -> DataFrame:
        states = self.spark.read.schema(self.STATES).parquet(f"{self.root}/states").drop("period")
        return P.rollup_of(states if unit == "hour" else P.coarser_states(states, unit))


def write_history(prices_df: DataFrame, path: str, unit: str = "day") -> None:
    """Store price rows in one partition per calendar unit, so that reports and retention touch few of them."""
    (
        prices_df.withColumn("price_period", F.to_date(F.date_trunc(unit, "timestamp")))
        .hint("rebalance", F.col("price_period"))
        .write.mode("overwrite")
        .partitionBy("price_period")
        .parquet(path)
    )


def drop_expired(spark: SparkSession, path: str, as_of: Column, days: int = 90, unit: str = "day") -> None:
    """Remove the periods of a stored history that ended before the retained days; no row is read.

    The names of the periods come from the folders, so the driver sees one row per period.
    """
    oldest = F.to_date(F.date_trunc(unit, P.since(as_of, days)))
    periods = spark.read.parquet(path).select("price_period").distinct()
    for row in periods.filter(F.col("price_period") < oldest).toLocalIterator():
        files.remove(spark, f"{path}/price_period={row.price_period}")

