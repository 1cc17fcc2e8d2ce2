"""Shapes of plans that must hold at any size."""

from __future__ import annotations

import pathlib
import re

import pytest

import __spark_entry__ as entry
from martlens.plans.registry import REGISTRY

FOLDER = "/root/testdata/sf0.001"
LIBRARY = pathlib.Path(__file__).parent.parent / "martlens"
WRITES = re.compile("staged|streamed|stage_|stored|round_trip|sink")


def plan_of(spark, name):
    return entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in REGISTRY if not WRITES.search(n)))
def test_no_query_pairs_everything(spark, name):
    plan = plan_of(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # a fixed number of partitions would depend on the cluster, and AQE could not split them
    assert "REPARTITION_BY_NUM" not in plan


@pytest.mark.parametrize("name", ["top_20_products", "top_selling_products", "newest_reviews", "keyword_cloud", "next_category"])
def test_limits_are_top_k(spark, name):
    assert "TakeOrderedAndProject" in plan_of(spark, name)


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(spark, "product_scan")
    assert "GreaterThanOrEqual(p_size,10)" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_brand:string,p_size:int>" in plan


def test_prices_combine_before_their_shuffle(spark):
    plan = plan_of(spark, "price_history")
    scan, partial = plan.index("FileScan parquet [l_partkey"), plan.index("partial_max")
    assert "Exchange" not in plan[partial:scan]


def test_latest_price_is_a_hash_aggregate(spark):
    plan = plan_of(spark, "latest_price")
    assert "SortAggregate" not in plan and "Window" not in plan


def test_operators_collect_nothing_to_the_driver():
    for path in (p for p in LIBRARY.rglob("*.py") if p.parent.name != "llm"):
        text = path.read_text()
        for word in (".collect()", ".toPandas(", "localCheckpoint", ".crossJoin(", "F.broadcast("):
            assert word not in text, f"{word} in {path}"


def test_every_query_says_what_it_covers():
    assert all(q.covers for q in REGISTRY.values())
