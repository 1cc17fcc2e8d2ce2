"""Sizes of tasks are made smaller, never larger."""

from __future__ import annotations

import pytest

from martlens import session


@pytest.mark.parametrize("before, after", [("128MB", "32m"), ("1g", "32m"), ("33554433b", "32m"), ("1m", "1m"), ("33554432", "33554432")])
def test_sizes_are_only_made_smaller(spark, before, after):
    other = spark.newSession()
    other.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert session.configure(other).conf.get("spark.sql.files.maxPartitionBytes") == after
    assert session.n_bytes(other.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")) <= 16 << 20
