"""The Arrow kernels against the column expressions and the plain statements, and the plans that use them."""

import plain
import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  (registers the queries)
from matnworks.fixed_values import FEATURES
from matnworks.functions import words
from matnworks.operators import cleaning
from matnworks.plans import learning

ODD = [None, "", " ", "في من\u00a0", "على", "ال_ي", "الxي.النصي ", "\u3000a\x85b\x1c", "ـــ ً", "والكتابها في", "من،من من ؟؛", "é’ 12٣ 🙂 في\u2003"]


@pytest.fixture(scope="module")
def texts():
    return [*plain.random_texts(2000, seed=11), *ODD, "كتاب من " * 30_000, "x" * 100_000]


def test_batches_equal_expressions(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    new = cleaning.prepare(df)
    old = cleaning.with_features(cleaning.with_clean_text(df))
    assert new.schema == old.schema
    assert new.orderBy("doc_id").collect() == old.orderBy("doc_id").collect()


def test_slices_change_nothing(monkeypatch, texts):
    pa = words.pa
    few = pa.array(texts[-200:])
    whole = [next(run(iter([few]))).to_pylist() for run in (words._cleaned, words._feature_counts)]
    monkeypatch.setattr(words, "SLICE_BYTES", 60)
    assert [next(run(iter([few[3:]]))).to_pylist() for run in (words._cleaned, words._feature_counts)] == [x[3:] for x in whole]
    assert [len(next(run(iter([few[:0]])))) for run in (words._cleaned, words._feature_counts)] == [0, 0]


def test_batches_equal_plain_statements(texts):
    rows = next(words._feature_counts(iter([words.pa.array(texts)]))).to_pylist()
    clean = next(words._cleaned(iter([words.pa.array(texts)]))).to_pylist()
    for text, row, cleaned in zip(texts, rows, clean, strict=True):
        size = len(text or "") or 1
        digits, marks, adjectives, genitives, gini = plain.features(text)
        assert cleaned == plain.clean(text)
        assert (row["digits"] / size, row["marks"] / size, row["adjectives"], row["genitives"]) == (digits, marks, adjectives, genitives)
        assert row["gini"] == pytest.approx(gini, abs=1e-12)


def test_own_clean_text_stays_and_features_come_alone(spark):
    df = spark.createDataFrame([("الكتاب", "mine")], "text string, clean_text string")
    assert cleaning.prepare(df).first().clean_text == "mine"
    assert cleaning.prepare(df.select("text"), clean=False).columns == ["text", *FEATURES]


def test_scored_texts_are_prepared_by_batches_once(spark, sf_dir):
    """Before, every word of a scored text went through interpreted expressions."""
    plan = learning.prepared_documents(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 2 and "lambda" not in plan and "split(" not in plan


def test_no_filter_runs_the_batches_again(spark, sf_dir):
    docs = learning.prepared_documents(spark, sf_dir).where(F.col("f87_gini").isNotNull() & F.col("f3_digits_ratio").isNotNull())
    assert docs._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 2
