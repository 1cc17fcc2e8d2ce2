"""Messages made from few files are dealt to many tasks."""

from __future__ import annotations

from martlens.plans import sample_messages
from martlens.plans.sample_model import SampleModel


def test_product_messages_are_spread_before_and_after_they_are_made(spark):
    rows = sample_messages.product_messages(SampleModel(spark, "/root/testdata/sf0.001"))
    plan = rows._jdf.queryExecution().optimizedPlan().toString().splitlines()
    dealt = [k for k, line in enumerate(plan) if "RepartitionByExpression" in line]
    made = next(k for k, line in enumerate(plan) if "Generate" in line)
    assert len(dealt) == 2 and dealt[0] < made < dealt[1]
