"""Append-only tables whose current rows are a fold over their log.

Plain Parquet has no MERGE, and rewriting a large table for every small batch would cost the
whole table each time.  So a batch only adds its own folder, `source=<stream>/batch_id=<n>`,
and overwrites that folder when it is replayed: writing a batch twice leaves the table as after
one write.  Readers fold the log by key.

A table with a key lays the rows of a batch into PARTS folders by a hash of the key, and a look-up of some keys reads
only the folders those keys fall into, which the plan shows as partition filters.  `settle` keeps the log
short: every MERGE finished batches become one run, MERGE runs one longer run, and so on, each with its log
shortened, so a log of n batches has about MERGE * log(n) folders and every row is rewritten log(n) times.

A run is written, then noted, then its batches are removed.  A crash before the note writes the run again, one after it only
removes again; rows that are in a run and in a batch at once do not change a fold.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from martlens.sources import files

Fold = Callable[[DataFrame], DataFrame]
#: Folders of one batch, and batches or runs that become one run.
PARTS, MERGE = 64, 8


class LogTable:
    """`fold` turns the log into current rows; `compaction` shortens a log without changing its fold."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        columns: str | T.StructType,
        fold: Fold | None = None,
        compaction: Fold | None = None,
        key: str | None = None,
    ):
        self.spark, self.path, self.key = spark, path, key
        self.schema = T.StructType.fromDDL(columns) if isinstance(columns, str) else columns
        self.fold, self.compaction = fold, compaction

    def create(self, rows: DataFrame | None = None) -> LogTable:
        """Write the base batch: the given rows, or none."""
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema]
        self.append(rows if rows is not None else self.spark.range(0).select(*nothing), "base", 0)
        return self

    def _part(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(PARTS)).cast("int")

    def append(self, rows: DataFrame, source: str, batch_id: int) -> None:
        self._write(rows.to(self.schema), f"{self.path}/source={source}/batch_id={batch_id}")

    def _write(self, typed: DataFrame, folder: str) -> None:
        if self.key is None:
            typed.write.mode("overwrite").parquet(folder)
            return
        dealt = typed.withColumn("part", self._part()).hint("rebalance", F.col("part"))
        dealt.write.mode("overwrite").partitionBy("part").parquet(folder)

    def _read(self, *folders: str) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField("source", T.StringType()), T.StructField("batch_id", T.LongType())])
        if self.key is not None:
            schema = schema.add("part", T.IntegerType())
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*(folders or (self.path,)))

    def log(self, among: DataFrame | None = None, before: tuple[str, int] | None = None) -> DataFrame:
        """All rows ever written, or those of the keys in `among`; `before` leaves out one batch of one source."""
        rows = self._read()
        if before is not None:
            rows = rows.where((F.col("source") != before[0]) | (F.col("batch_id") != before[1]))
        if among is not None:
            if self.key is None:
                raise ValueError(f"{self.path} has no key to look rows up by")
            keys = among.select(self.key)
            # PARTS numbers at most, however many keys
            parts = keys.agg(F.collect_set(self._part()).alias("parts")).first().parts
            rows = rows.where(F.col("part").isin(parts)).join(keys, self.key, "left_semi")
        return rows.select(*self.schema.fieldNames())

    def current(self, among: DataFrame | None = None) -> DataFrame:
        """The folded rows, of all keys or only of those in `among`."""
        rows = self.log(among)
        return self.fold(rows) if self.fold else rows

    def settle(self, source: str, batch_id: int) -> None:
        """Before a batch is handled, merge the batches that ended before it, where they fill a run."""
        if self.compaction is None:
            return
        span, level = 1, 0
        while batch_id and batch_id % (span * MERGE) == 0:
            name = f"source={source}" + (f".{level}" if level else "")
            first = batch_id - span * MERGE
            merged = [f"{self.path}/{name}/batch_id={first + k * span}" for k in range(MERGE)]
            run = f"source={source}.{level + 1}/batch_id={first}"
            if not self._noted(run):
                try:
                    self._write(self.compaction(self._read(*merged).select(*self.schema.fieldNames())), f"{self.path}/{run}")
                except AnalysisException as missing:  # this source does not feed the table
                    if missing.getCondition() != "PATH_NOT_FOUND":
                        raise
                    return
                self.spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{self.path}.runs/{run}")
            for folder in merged:
                files.remove(self.spark, folder)
            span, level = span * MERGE, level + 1

    def _noted(self, run: str) -> bool:
        try:
            return not self.spark.read.schema("id BIGINT").parquet(f"{self.path}.runs/{run}").isEmpty()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return False

    def compact_to(self, path: str) -> LogTable:
        """Write the shortened log to another folder, as a table that goes on from there."""
        table = LogTable(self.spark, path, self.schema, self.fold, self.compaction, self.key)
        return table.create(self.compaction(self.log()) if self.compaction else self.log())
