"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import pathlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martlens.session import configure

#: Rows handed to Python at once; texts may be long, so a batch stays at a few megabytes.
ARROW_ROWS = 256


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on; the checkpoint folder is only set where it is unset."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    context = spark.sparkContext
    # where workers share the driver's disk they import this package from here; a cluster gets it by --py-files
    context.environment.setdefault("PYTHONPATH", str(pathlib.Path(__file__).resolve().parents[2]))
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return spark


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage through files in the shared checkpoint folder, which outlive any executor."""
    prepare(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Like `durable`, but as compressed columns; the shuffle files behind it are removed with the job."""
    spark = prepare(df.sparkSession)
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup, "false")
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    spark.conf.set(cleanup, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(cleanup, before)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def whole_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text); a null text is empty, and all other columns stay behind."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def fold(id_col: str, parts: int) -> Column:
    """The crc32 of an id's decimal text, modulo `parts`."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % parts


def thinned(id_col: str, size: int | Column, count: int | Column) -> Column:
    """Whether a row is among about three times `size` of `count` rows, by a hash of its id.

    Taking the first `size` of these instead of all keeps what every task sends for it small.
    """
    scale = 1 << 30
    wanted = F.lit(3.0 * scale) * (F.lit(size) if isinstance(size, int) else size)
    return F.pmod(F.xxhash64(id_col, F.lit("thinned")), F.lit(scale)) * (F.lit(count) if isinstance(count, int) else count) < wanted


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, sizes: dict[int, int]) -> DataFrame:
    """(doc_id, label, text) of at most sizes[c] labelled documents per class c, taken in the order of a hash of their ids.

    Only ids are sorted; they are bounded, so they are broadcast and no text is shuffled to find the sample.
    Rows that repeat an id count once.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).where("doc_id is not null")
    counts = known.agg(*(F.count_if(F.col("label") == kind) for kind in sizes)).first()
    picks = None
    for (kind, size), count in zip(sizes.items(), counts, strict=True):
        some = known.where((F.col("label") == kind) & thinned("doc_id", size, count)).dropDuplicates(["doc_id"])
        some = some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)
        picks = some if picks is None else picks.unionByName(some)
    texts = whole_texts(docs).where("doc_id is not null")
    return texts.join(F.broadcast(picks), "doc_id").select("doc_id", "label", "text").dropDuplicates(["doc_id"])


def where_texts(docs: DataFrame, keep: Callable[[list[str]], np.ndarray], text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, whose texts `keep` says yes to; a null text is judged as empty."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(keep([t or "" for t in b[text_col].to_pylist()]), pa.bool_()))

    return docs.mapInArrow(rows, docs.schema)
