"""Declared schemas, table scans and topic files."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F, types as T

from martlens import schemas
from martlens.session import work_dir
from martlens.sources import files, messages


@pytest.mark.parametrize("table", sorted(schemas.TABLES))
def test_tables_can_be_written_and_scanned(spark, tmp_path, table):
    schema = T.StructType.fromDDL(schemas.TABLES[table])
    path = str(tmp_path / table)
    spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema]).write.parquet(path)
    first = schema.fieldNames()[0]
    df = files.read_table(spark, path, table, [first])
    assert df.count() == 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert f"ReadSchema: struct<{first}:" in plan and plan.count(",", plan.index("ReadSchema: ")) == 0


def test_payload_schemas_are_valid():
    for name in ("PAGE", "LISTING_ITEM", "CATALOG_ITEM", "PRODUCT_DETAIL", "REVIEW_DETAIL", "REVIEW_STARS", "PRODUCT_MESSAGE",
                 "SHOP_MESSAGE", "ORDER_MESSAGE", "SENTIMENT_MESSAGE", "DETAIL_REQUEST", "REVIEW_REQUEST"):
        assert T.StructType.fromDDL(getattr(schemas, name)).fields


def test_topics(spark, tmp_path):
    rows = [("product", 1, None), ("shop", None, 2), ("review", 1, None), ("banner", 1, None), (None, 1, None)]
    items = spark.createDataFrame(rows, "item_type string, product_id bigint, shop_id bigint")
    messages.write_topics(messages.routed(items), str(tmp_path / "t"))
    assert sorted(d for d in os.listdir(tmp_path / "t") if "=" in d) == ["topic=products", "topic=reviews", "topic=shops"]
    keys = {r.topic: r.key for r in messages.routed(items).collect()}
    assert keys == {"products": "1", "reviews": "1", "shops": "2"}


def test_work_dir_lies_in_the_shared_folder(spark):
    assert work_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert work_dir(spark, "x") != work_dir(spark, "x")
