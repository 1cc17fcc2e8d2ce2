"""From raw documents to packed training sequences: STAGES in order, each written and read again.

Every stage works on all rows that the one before kept.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from martlens.llm import near_copies, packing, quality, repeats, toxicity
from martlens.llm.common import prepare, stored, table
from martlens.llm.queries import VOCABULARY, unheld


def good_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose labelled neighbours vote for them; learned from the labels that are not held out."""
    model = quality.learn(docs, unheld(table(spark, folder, "labels")))
    return quality.good(docs, model)


def not_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents below the toxicity threshold; learned from the labels that are not held out."""
    model = toxicity.learn(docs, unheld(table(spark, folder, "labels")))
    return toxicity.without_toxic(docs, model)


def one_of_each_group(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The smallest id of every group of documents linked by a Jaccard similarity of 0.8 or more on five-word shingles."""
    prepare(spark)
    return near_copies.without_near_copies(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every passage of 100 bytes stays where it occurs first; n_chars is counted anew."""
    prepare(spark)
    cut = repeats.deduplicated(docs)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cut


def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    prepare(spark)
    return packing.packed(docs, VOCABULARY)


STAGES = [
    ("quality classifier", good_quality),
    ("toxicity", not_toxic),
    ("near duplicates", one_of_each_group),
    ("repeated passages", without_repeated_passages),
    ("best-fit packing", packed),
]

#: SQL can neither fit the classifiers nor tokenise; the stages are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, folder))
    return docs
