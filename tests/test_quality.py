"""Contracts and table checks."""

from __future__ import annotations

from martlens.operators import quality as Q

PRODUCT = "product_id bigint, name string, shop_id bigint, url string, rating double, sold_count int"


def test_product_contract(spark):
    rows = [
        (1, "ok", 1, "u", 4.5, 0),
        (2, "", None, "u", 5.5, -1),
        (None, "x" * 1001, 1, None, None, None),
    ]
    df = spark.createDataFrame(rows, PRODUCT)
    assert [r.product_id for r in Q.valid_rows(df, Q.PRODUCT).collect()] == [1]
    reasons = sorted(r.reason for r in Q.reject_rows(df, Q.PRODUCT).collect())
    assert reasons == [
        "product_id_required,url_required,name_length",
        "shop_id_required,name_length,rating_range,sold_count_min",
    ]
    counts = {r.rule: (r.checked, r.violations) for r in Q.violation_counts(df, Q.PRODUCT).collect()}
    assert counts["name_length"] == (3, 2) and counts["rating_range"] == (3, 1)


def test_null_is_a_violation_only_where_required(spark):
    df = spark.createDataFrame([(None, None)], "sentiment string, confidence_score double")
    assert Q.valid_rows(df, Q.SENTIMENT).count() == 1
    assert Q.valid_rows(df, Q.TABLE_CHECKS["review_sentiment"]).count() == 0


def test_missing_required_is_truthy(spark):
    df = spark.createDataFrame([(0, ""), (1, "x"), (None, "y")], "a int, b string")
    assert [tuple(r) for r in Q.has_required(df, ["a", "b"]).collect()] == [(1, "x")]
    found = sorted(str(r.missing) for r in Q.missing_required(df, ["a", "b"]).collect())
    assert found == ["['a', 'b']", "['a']"]


def test_orphans_of_a_hot_key_are_counted(spark):
    child = spark.createDataFrame([(9,)] * 500 + [(1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,)], "id int")
    row = Q.orphan_count(child, "k", parent, "id", "c.k").first()
    assert tuple(row) == ("c.k", 501, 2)


def test_reports(spark):
    df = spark.createDataFrame([(1, " "), (1, None), (2, "a")], "k int, s string")
    assert tuple(Q.uniqueness("t", df, ["k"]).first()) == ("t", 3, 2, 1)
    cells = {r.column_name: (r.nulls, r.blanks) for r in Q.null_report(df, ["k", "s"]).collect()}
    assert cells == {"k": (0, 0), "s": (1, 1)}
