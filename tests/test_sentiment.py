"""Scoring with the lexicon and with a model."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from martlens.functions import scalars as X
from martlens.operators import sentiment as M


class Shouting:
    """Raw labels in capitals; fails on a batch that holds the word 'crash'."""

    def predict(self, texts):
        if any("crash" in t for t in texts):
            raise RuntimeError("model failed")
        return [("LABEL_1" if "!" in t else "LABEL_0" if "?" in t else "LABEL_7", 0.87654321) for t in texts]


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "review_id int, comment string")


def scores(df):
    return {r.review_id: (r.sentiment, r.confidence) for r in df.collect()}


def test_lexicon(spark):
    got = scores(M.score_with_lexicon(texts(spark, "Good, GREAT thing", "bad", "", None, "good bad", "goodness", "sản phẩm tốt")))
    assert got[0] == ("positive", round(1 / (1 + math.exp(-2)), 4))
    assert got[1] == ("negative", 0.7311)
    assert got[2] == got[3] == got[4] == got[5] == ("neutral", 0.0)
    assert got[6] == ("positive", 0.7311)


def test_model_labels_blanks_and_failures(spark):
    df = texts(spark, "yes!", "why?", "hm", "  ", None, "crash", "later!").coalesce(1)
    got = scores(M.score_with_model(df, Shouting, batch_size=3))
    assert got[0] == ("positive", 0.8765) and got[1] == ("negative", 0.8765) and got[2] == ("neutral", 0.8765)
    assert got[3] == got[4] == ("neutral", 0.0)
    # the failing batch holds 'crash' and 'later!'
    assert got[5] == got[6] == ("neutral", 0.0)


def test_model_runs_once_per_row_under_a_filter(spark):
    scored = M.score_with_model(texts(spark, "yes!"), Shouting).filter("sentiment = 'positive'")
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_lexicon_model_equals_lexicon(spark):
    df = texts(spark, "good good bad", "Worst. idea; ever", "x", "nice²nice")
    a, b = scores(M.score_with_lexicon(df)), scores(M.score_with_model(df, M.LexiconModel))
    assert a == b


@pytest.mark.parametrize("values", [[0.1, 0.9, -2.0], [1000.0, 1000.0], [-5.0]])
def test_softmax(spark, values):
    df = spark.createDataFrame([(values,)], "v array<double>").select(X.softmax(F.col("v")).alias("p"), X.argmax(F.col("v")).alias("a"))
    row = df.first()
    top = max(values)
    exps = [math.exp(v - top) for v in values]
    assert row.p == pytest.approx([e / sum(exps) for e in exps])
    assert row.a == values.index(top)


def test_mismatches(spark):
    df = spark.createDataFrame([(1, 5, "negative"), (2, 1, "positive"), (3, 3, "negative"), (4, 5, "positive")], "review_id int, rating int, sentiment string")
    assert sorted((r.review_id, r.mismatch) for r in M.mismatches(df).collect()) == [(1, "high_rating_negative"), (2, "low_rating_positive")]


def test_chunks_are_of_like_lengths():
    lengths = [5, 900, 7, 880, 6, 10, 2000, 4]
    by_length = M.chunks_by_length(lengths, 3)
    assert by_length == [[7, 0, 4], [2, 5, 3], [1, 6]]
    assert sorted(sum(by_length, [])) == list(range(8))
    bounded = M.chunks_by_length(lengths, 3, 1800)
    assert bounded == [[7, 0, 4], [2, 5], [3, 1], [6]]
    in_order = [[0, 1, 2], [3, 4, 5], [6, 7]]
    assert M.padding_share(lengths, bounded) < M.padding_share(lengths, by_length) < M.padding_share(lengths, in_order)
    assert M.chunks_by_length([], 8) == [] and M.padding_share([], []) == 0


def test_balance_in_one_scan(spark):
    texts = ["Good, good! bad", "goods badly", "xgood", "TỐT tệ tốt", None, "", "good-bad_good", "gut"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.b for r in df.select("i", M.word_balance("t").alias("b")).orderBy("i").collect()]
    assert got == [1, 0, 0, 1, 0, 0, 1, 0]
