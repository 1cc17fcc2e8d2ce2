"""A streaming source over landed message partitions, read by partition and offset like a broker's.

A landed topic is a folder of Parquet files under `partition=<n>`, each with the columns offset, timestamp, key and value.
Progress is the next offset of every partition, however many files hold it: the newest offsets come from the
files' footers, and a batch asks each file for its part of the offsets, whose row groups are skipped by their
statistics.  Each file that overlaps a batch is a task, so a partition that holds most messages is read by many.

Defined cases: a message landed again under an offset that was read already is left out; gaps between offsets are
allowed; a partition that appears later begins at its smallest offset; a folder without files gives no rows.
Rows without an offset are not messages of a partition and are left out.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

NAME = "landed_partitions"
RECORDS = "partition INT, offset BIGINT, timestamp TIMESTAMP, key STRING, value STRING"
#: Rows of one Arrow batch; values may be long.
BATCH_ROWS = 4096


@dataclass
class Span(InputPartition):
    """The offsets of one file that belong to a batch: from `start`, before `end`."""

    file: str
    partition: int
    start: int
    end: int


def _open(path: str):
    """The file system of a path or URI and the path there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class LandedReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.starting = {k: int(v) for k, v in json.loads(options.get("startingoffsets", "{}")).items()}
        self.files: dict[str, tuple[int, int, int]] = {}

    def _look(self) -> None:
        """Take in the partition and the lowest and highest offset of files not seen before."""
        from pyarrow import fs, parquet

        system, root = _open(self.path)
        for info in system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            folder, name = info.path.rsplit("/", 2)[-2:]
            hidden = name.startswith((".", "_")) or "/_" in info.path[len(root) :]
            if info.path in self.files or info.type != fs.FileType.File or hidden or not folder.startswith("partition="):
                continue
            meta = parquet.read_metadata(info.path, filesystem=system)
            at = meta.schema.to_arrow_schema().get_field_index("offset")
            stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
            known = [s for s in stats if s is not None and s.has_min_max]
            if known:
                self.files[info.path] = (int(folder.split("=")[1]), min(s.min for s in known), max(s.max for s in known))

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        self._look()
        newest: dict[str, int] = {}
        for partition, _, high in self.files.values():
            newest[str(partition)] = max(newest.get(str(partition), 0), high + 1)
        return newest

    def partitions(self, start: dict, end: dict) -> list[Span]:
        self._look()
        spans = []
        for file, (partition, low, high) in sorted(self.files.items()):
            key = str(partition)
            begin = max(start.get(key, self.starting.get(key, low)), low)
            stop = min(end.get(key, 0), high + 1)
            if begin < stop:
                spans.append(Span(file, partition, begin, stop))
        return spans

    def read(self, span: Span) -> Iterator:
        import pyarrow as pa
        import pyarrow.dataset as ds

        system, _ = _open(self.path)
        inside = (ds.field("offset") >= span.start) & (ds.field("offset") < span.end)
        kinds = [pa.int32(), pa.int64(), pa.timestamp("us", "UTC"), pa.string(), pa.string()]
        names = ["offset", "timestamp", "key", "value"]
        for b in ds.dataset(span.file, filesystem=system, format="parquet").to_batches(columns=names, filter=inside, batch_size=BATCH_ROWS):
            columns = [pa.array([span.partition] * len(b), kinds[0])]
            columns += [b[n].cast(k) for n, k in zip(names, kinds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["partition", *names])


class LandedPartitions(DataSource):
    """Options: path, and startingOffsets, a JSON object of partition and first offset; others begin at their smallest."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return RECORDS

    def streamReader(self, schema) -> LandedReader:
        return LandedReader({k.lower(): v for k, v in dict(self.options).items()})


def stream_records(spark: SparkSession, path: str, starting: dict[int, int] | None = None) -> DataFrame:
    """The records of a landed topic as a stream, in the shape of RECORDS."""
    # the reader travels whole, so executors need not have this package
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(LandedPartitions)
    options = {"path": path, "startingOffsets": json.dumps({str(k): v for k, v in (starting or {}).items()})}
    return spark.readStream.format(NAME).options(**options).load()


def land(records: DataFrame, path: str) -> None:
    """Append records to a landed topic, rebalanced by partition, so that a large one gets several files."""
    rows = records.select("partition", "offset", "timestamp", "key", "value").hint("rebalance", "partition")
    rows.sortWithinPartitions("partition", "offset").write.mode("append").partitionBy("partition").parquet(path)
