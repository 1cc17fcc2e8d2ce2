"""Texts are the last thing that scored reviews are joined with."""

from __future__ import annotations

from martlens.plans import reports
from martlens.plans.sample_model import SampleModel


def test_no_text_is_carried_through_the_join_by_review(spark):
    plan = reports.scored_review_detail(SampleModel(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert "doc_id" in joins[0] and any("review_id" in line for line in joins[1:])


def test_reviews_of_one_text_lie_together(spark):
    rows = reports.scored_review_detail(SampleModel(spark, "/root/testdata/sf0.001"))
    joins = [line for line in rows._jdf.queryExecution().sparkPlan().toString().splitlines() if "Join" in line]
    assert "SortMergeJoin [doc_id" in joins[0]
