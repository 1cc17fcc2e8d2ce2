"""JSON message streams in and out."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from martlens import schemas
from martlens.functions import scalars as X
from martlens.sources import partitions

TOPIC = "topic"
#: Where a message stands among all others; numbers are compared one after the other, so none has to fit into another.
PLACE = "STRUCT<at: BIGINT, part: INT, offset: BIGINT, position: INT>"
LANDED = "seq BIGINT, timestamp TIMESTAMP, partition INT, offset BIGINT, key STRING, value STRING"


def place(at: Column, part: Column | None = None, offset: Column | None = None, position: Column | None = None) -> Column:
    """A message's place: its number or time, then its partition, its offset there, and its position if it is part of a message."""
    zero = F.lit(0)
    return F.struct(
        at.cast("bigint").alias("at"),
        (zero if part is None else part).cast("int").alias("part"),
        (zero if offset is None else offset).cast("bigint").alias("offset"),
        (zero if position is None else position).cast("int").alias("position"),
    )


def json_messages(raw: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """Decode message bodies.  Undecodable ones keep their text in `corrupt`; nothing is dropped.

    `present` lists the keys of the message, so a missing key differs from a null one.
    """
    fields = T.StructType.fromDDL(schema)
    body = F.col(value).cast("string")
    how = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt"}
    with_corrupt = T.StructType([*fields.fields, T.StructField("corrupt", T.StringType())])
    both = F.struct(
        F.from_json(body, with_corrupt, how).alias("m"), F.json_object_keys(body).alias("keys")
    )
    read = X.once(raw.withColumn("_body", body), "_p", both)
    # only objects have keys, so arrays and plain values count as corrupt too
    bad = F.col("_p.m.corrupt").isNotNull() | F.col("_p.keys").isNull()
    return read.select(
        *[c for c in raw.columns if c != value],
        *[F.col(f"_p.m.{n}") for n in fields.fieldNames()],
        F.coalesce("_p.keys", F.array().cast("array<string>")).alias("present"),
        F.when(bad, F.coalesce("_body", F.lit(""))).alias("corrupt"),
    )


def decoded(messages: DataFrame) -> DataFrame:
    return messages.filter(F.col("corrupt").isNull()).drop("corrupt")


def corrupt(messages: DataFrame) -> DataFrame:
    return messages.filter(F.col("corrupt").isNotNull()).select(
        F.col("corrupt").alias("value"), F.lit("not a JSON object").alias("reason")
    )


def read_stream(spark: SparkSession, fmt: str, options: dict[str, str], path: str | None = None) -> DataFrame:
    """A message stream from its beginning, as seq (a place), key and value.

    fmt="kafka" needs Spark's Kafka connector on the class path.  fmt="json" reads landed files
    of such messages, numbered or with time, partition and offset; fmt="partitions" a folder of landed partitions by offset.
    """
    if fmt == "partitions":
        starting = {int(k): v for k, v in json.loads(options.get("startingOffsets", "{}")).items()}
        return from_kafka(partitions.stream_records(spark, path, starting))
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "kafka":
        return from_kafka(reader.option("startingOffsets", "earliest").load())
    return landed(reader.schema(LANDED).load(path))


def landed(rows: DataFrame) -> DataFrame:
    """Rows of LANDED as messages; those with an offset are placed like Kafka records, others by their number."""
    kafka = place(F.unix_millis("timestamp"), F.col("partition"), F.col("offset"))
    return rows.select(F.when(F.col("offset").isNotNull(), kafka).otherwise(place(F.col("seq"))).alias("seq"), "key", "value")


def from_kafka(records: DataFrame) -> DataFrame:
    """Kafka records to messages; `seq` rises with time and, within a millisecond, with partition and offset."""
    seq = place(F.unix_millis("timestamp"), F.col("partition"), F.col("offset"))
    return records.select(
        seq.alias("seq"), F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")
    )


def keyed(df: DataFrame, key: str | None, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows to messages: text key and JSON value.  Nulls are written out, not left away."""
    body = F.to_json(F.struct(*(columns or df.columns)), {"ignoreNullFields": "false"})
    name = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return df.select(name.alias("key"), body.alias("value"))


def topic_of(item_type: Column) -> Column:
    """The topic of an item type; unknown types have none."""
    pairs = [F.lit(x) for kv in schemas.ITEM_TOPICS.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), item_type)


def routed(items: DataFrame) -> DataFrame:
    """Items with their topic and key; items of unknown type are left out."""
    kind = F.col("item_type")
    key = F.when(kind == "shop", F.col("shop_id")).otherwise(F.col("product_id"))
    return (
        items.withColumn(TOPIC, topic_of(kind))
        .filter(F.col(TOPIC).isNotNull())
        .withColumn("key", key.cast("string"))
    )


def stream_topics(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Send a stream of messages with a topic to JSON files, one folder per topic, each message exactly once."""
    query = (
        stream.writeStream.format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(TOPIC)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def write_topics(messages: DataFrame, path: str) -> None:
    """Land messages as JSON files, one folder per topic."""
    messages.write.mode("overwrite").partitionBy(TOPIC).json(path)
