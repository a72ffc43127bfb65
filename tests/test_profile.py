import math

import pytest

from matnworks.operators import cleaning, profile, reports, split

SCHEMA = "doc_id long, label int, text string"


def test_clean_corpus_drops_missing_text_and_labels(spark):
    df = spark.createDataFrame(
        [("a", "1"), ("", "1"), (None, "0"), ("b", None), ("c", "spam"), ("d", "0")], "text string, label string"
    )
    assert [tuple(r) for r in cleaning.clean_corpus(df).orderBy("text").collect()] == [("a", 1), ("d", 0)]
    assert dict(cleaning.clean_corpus(df, "double").dtypes)["label"] == "double"


def test_null_profile_counts_null_empty_and_nan(spark):
    df = spark.createDataFrame(
        [("", 1.0, 1), (None, float("nan"), None), ("x", None, 2)], "s string, d double, i int"
    )
    assert tuple(profile.null_profile(df).first()) == (2, 2, 1)


@pytest.mark.parametrize(
    "labels,expected",
    [
        ([0, 1, 1, 1, None], (1, 3, 25.0, 75.0, 3.0)),
        ([1, 1], (0, 2, 0.0, 100.0, math.inf)),
        ([0], (1, 0, 100.0, 0.0, 0.0)),
        ([], (0, 0, None, None, math.inf)),
    ],
)
def test_class_imbalance(spark, labels, expected):
    df = spark.createDataFrame([(x,) for x in labels], "label int")
    assert tuple(profile.class_imbalance(df).first()) == expected


def test_class_weights(spark):
    df = spark.createDataFrame([(x,) for x in [0.0, 1.0, 1.0, 1.0]], "label double")
    assert {r.label: r.weight for r in profile.class_weights(df).collect()} == {0: 2.0, 1: 4 / 6}
    weighted = {(r.label, r.classWeight) for r in profile.with_class_weight(df).collect()}
    assert weighted == {(0.0, 2.0), (1.0, 4 / 6)}


def test_weight_of_an_empty_class_is_one(spark):
    df = spark.createDataFrame([(1,), (1,)], "label int")
    assert {r.label: (r.n, r.weight) for r in profile.class_weights(df).collect()} == {0: (0, 1.0), 1: (2, 0.5)}


def test_preview_cuts_long_strings(spark):
    df = spark.createDataFrame([(2, 0, "x" * 81), (1, 0, "y" * 80), (3, 0, "z")], SCHEMA)
    rows = cleaning.preview(df, "doc_id", 2, 80).collect()
    assert [r.doc_id for r in rows] == [1, 2]
    assert [r.text for r in rows] == ["y" * 80, "x" * 77 + "..."]


def test_feature_summary_rounding_and_missing_label(spark):
    names = "f3_digits_ratio f24_punct_div f45_adj_count f66_genitive_count f87_gini".split()
    row = (1, 0.1234564, 0.0, 1.0, 2.0, 0.1234564)
    df = spark.createDataFrame([row], "label int, " + ", ".join(f"{n} double" for n in names))
    out = {r.feature: r for r in reports.feature_summary(df).collect()}
    assert out["f3_digits_ratio"].human_mean == 0.0
    assert out["f3_digits_ratio"].difference == 0.123456
    assert out["f87_gini"].description == "f87 - Gini coeff"


def test_gini_difference_is_rounded_only_once(spark):
    names = "f3_digits_ratio f24_punct_div f45_adj_count f66_genitive_count f87_gini".split()
    rows = [(0, *[0.0000004] * 5), (1, *[0.0000016] * 5)]
    df = spark.createDataFrame(rows, "label int, " + ", ".join(f"{n} double" for n in names))
    out = {r.feature: r.difference for r in reports.feature_summary(df).collect()}
    assert out["f3_digits_ratio"] == 0.000002
    assert out["f87_gini"] == 0.000001


def test_split_covers_every_row_once_and_ignores_partitioning(spark):
    df = spark.range(2000).withColumnRenamed("id", "doc_id")
    parts = {name: {r.doc_id for r in split.take(df, name).collect()} for name in split.BOUNDS}
    assert sum(map(len, parts.values())) == 2000
    assert set.union(*parts.values()) == set(range(2000))
    assert 0.65 < len(parts["train"]) / 2000 < 0.75
    named = {r.doc_id: r.s for r in df.repartition(7).select("doc_id", split.split_name().alias("s")).collect()}
    assert all(named[i] == name for name, ids in parts.items() for i in ids)
