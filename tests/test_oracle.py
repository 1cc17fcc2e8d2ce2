"""Every registered query against its SQL on the smallest sample tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from tests import oracle_check

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return oracle_check.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, FOLDER)
    if name in SQL:
        assert oracle_check.compare(result, duck, SQL[name]) is None
    else:
        assert result.count() > 0


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 100
