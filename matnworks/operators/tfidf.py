"""TF-IDF as a relation: one row per document and term, exact terms instead of hash slots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matnworks.fixed_values import MIN_DOC_FREQ
from matnworks.functions.tokens import run_counts
from matnworks.sources.files import materialize

# A term in more than this share of all (document, term) rows is frequent. There can be at most
# 1 / HOT_SHARE such terms, whatever the size of the corpus.
HOT_SHARE = 1e-5


def term_frequencies(df: DataFrame, tokens: Column) -> DataFrame:
    """``doc_id, term, tf``; counted inside each row, so no shuffle."""
    return df.select("doc_id", F.inline(run_counts(tokens))).toDF("doc_id", "term", "tf")


def tfidf(df: DataFrame, tokens: Column, min_doc_freq: int = MIN_DOC_FREQ) -> DataFrame:
    """``doc_id, term, tf, df, tfidf`` with idf = ln((N + 1) / (df + 1)), 0 below ``min_doc_freq``.

    Document frequencies are looked up in two ways. Frequent terms, at most 1 / HOT_SHARE of them, are
    broadcast, so the many rows that carry them are not shuffled; the others meet their frequency in
    a shuffle join in which no key is large. Term frequencies are as many rows as the result, and are
    written once rather than cleaned and counted again for each use.
    """
    tf = materialize(term_frequencies(df, tokens), "tf")
    doc_freq = materialize(tf.groupBy("term").agg(F.count("*").alias("df")), "df")
    limit = doc_freq.agg(F.sum("df") * F.lit(HOT_SHARE)).scalar()
    hot = F.broadcast(doc_freq.filter(F.col("df") > limit))
    cold = doc_freq.filter(F.col("df") <= limit)
    looked_up = tf.join(hot, "term").unionByName(
        tf.join(hot.select("term"), "term", "left_anti").join(cold, "term")
    )
    n_docs = df.agg(F.count("*")).scalar()
    idf = F.when(
        F.col("df") >= min_doc_freq, F.log((n_docs + 1).cast("double") / (F.col("df") + 1).cast("double"))
    ).otherwise(F.lit(0.0))
    return looked_up.select(
        "doc_id", "term", F.col("tf").cast("bigint").alias("tf"), "df", (F.col("tf") * idf).alias("tfidf")
    )
