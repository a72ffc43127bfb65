import math
from collections import Counter

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from matnworks.operators import models, tfidf

FOUR = [(1, "a b"), (2, "a b"), (3, "a c"), (4, "a")]


def words(df):
    return F.split(F.col("clean_text"), " ")


def result(df, min_doc_freq):
    rows = tfidf.tfidf(df, words(df), min_doc_freq).collect()
    assert len({(r.doc_id, r.term) for r in rows}) == len(rows)
    return {(r.doc_id, r.term): (r.tf, r.df, r.tfidf) for r in rows}


def test_idf_threshold(spark):
    out = result(spark.createDataFrame(FOUR, "doc_id long, clean_text string"), 2)
    assert out[(1, "a")] == (1, 4, 0.0)
    assert out[(1, "b")][2] == pytest.approx(0.510826, abs=1e-6)
    assert out[(3, "c")] == (1, 1, 0.0)


@pytest.mark.parametrize("share", [1e-4, 0.2, 1.0])
def test_frequent_and_rare_terms_follow_the_same_formula(spark, monkeypatch, share):
    """Share 1e-4 makes every term frequent here, 1.0 makes every term rare, 0.2 mixes them."""
    monkeypatch.setattr(tfidf, "HOT_SHARE", share)
    texts = [" ".join(["hot"] * (i % 3 + 1) + [f"w{i % 7}", f"v{i}"]) for i in range(60)]
    out = result(spark.createDataFrame(list(enumerate(texts)), "doc_id long, clean_text string"), 3)
    doc_freq = Counter(t for text in texts for t in set(text.split()))
    expected = {
        (i, t): (n, doc_freq[t], n * math.log(61 / (doc_freq[t] + 1)) if doc_freq[t] >= 3 else 0.0)
        for i, text in enumerate(texts)
        for t, n in Counter(text.split()).items()
    }
    assert out.keys() == expected.keys()
    for key, (tf, df, weight) in expected.items():
        assert out[key][:2] == (tf, df)
        assert out[key][2] == pytest.approx(weight, abs=1e-12)


def test_hashed_weights_equal_term_weights(spark):
    """Without collisions each vector holds the same weights as the relation."""
    df = spark.createDataFrame(FOUR, "doc_id long, clean_text string")
    hashed = Pipeline(stages=models.tfidf_stages(min_doc_freq=2)).fit(df).transform(df)
    relation = result(df, 2)
    for row in hashed.collect():
        mine = sorted(v[2] for (doc, _), v in relation.items() if doc == row.doc_id)
        assert sorted(row.tfidf.values) == pytest.approx(mine, abs=1e-12)
