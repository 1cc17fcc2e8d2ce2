"""A refresh makes its states once."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from martlens.operators import prices as P
from martlens.streaming.rollups import StoredRollup


def test_states_of_a_refresh_are_made_once(spark, tmp_path, monkeypatch):
    made, real = spark.sparkContext.accumulator(0), P.price_states

    def count(product):
        made.add(1)
        return True

    counted = F.udf(count, "boolean").asNondeterministic()
    monkeypatch.setattr(P, "price_states", lambda prices: real(prices).filter(counted("product_id")))
    kept = StoredRollup(spark, str(tmp_path))
    day = lambda d: dt.datetime(2024, 1, d, 5)
    columns = "product_id long, price decimal(12,2), timestamp timestamp"
    kept.add(spark.createDataFrame([(p, Decimal(1), day(d)) for p in (1, 2) for d in (1, 2, 3)], columns), 0)
    kept.refresh(-1, 0)
    assert made.value == 6
    # the second day is withdrawn, the third changes
    kept.add(spark.createDataFrame([(1, None, day(2)), (2, None, day(2)), (1, Decimal(5), day(3))], columns), 1)
    kept.refresh(0, 1)
    assert made.value == 6 + 2
    assert {(r.product_id, r.bucket.day, int(r.max_price)) for r in kept.rollup().collect()} == {(1, 1, 1), (2, 1, 1), (1, 3, 5), (2, 3, 1)}
