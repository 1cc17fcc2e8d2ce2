"""Files: table scans, JSON lines, CSV."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from martlens import schemas


def read_table(spark: SparkSession, path: str, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A stored table with its declared schema; only the asked columns are scanned."""
    df = spark.read.schema(schemas.TABLES[table]).parquet(path)
    return df.select(*columns) if columns else df


def write_json_lines(df: DataFrame, path: str) -> None:
    """Crawl items as JSON lines; null fields are written so every line has every key."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


# Null and the empty text are written differently and stay apart; blanks around a text are kept.
CSV = {
    "header": "true",
    "escape": '"',
    "multiLine": "true",
    "nullValue": "\\N",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; null and '' stay apart and texts may hold line breaks."""
    df.write.mode("overwrite").options(**CSV).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).options(**CSV, emptyValue="").csv(path)


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder, whichever store it lies in; one that is gone already is no error."""
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
