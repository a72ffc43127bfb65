"""Filters and projections that turn a raw frame into the corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matnworks.functions import arabic, words
from matnworks.functions.stylometry import features


def with_doc_id(df: DataFrame) -> DataFrame:
    """Adds ``doc_id`` unless the frame brings its own: 128 bits of a digest of the text, the same on every run.

    Rows with one text are one document to every later step, so they fall in one part of the split.
    """
    digest = F.substring(F.sha2(F.coalesce("text", F.lit("")), 256), 1, 32)
    return df if "doc_id" in df.columns else df.withColumn("doc_id", digest)


def clean_corpus(df: DataFrame, label_type: str = "int") -> DataFrame:
    """Rows with a non-empty text and a valid label. A label that does not parse counts as null."""
    return (
        df.withColumn("label", F.col("label").try_cast(label_type))
        .dropna(subset=["text", "label"])
        .filter(F.col("text") != "")
    )


def processed_corpus(df: DataFrame) -> DataFrame:
    """Adds the normalised, stop-word-free and stemmed forms of ``text``, each made from the one before."""
    return (
        df.withColumn("normalized_text", arabic.normalize(F.col("text")))
        .withColumn("no_stopwords_text", arabic.remove_stopwords(F.col("normalized_text")))
        .withColumn("clean_text", arabic.stem_text(F.col("no_stopwords_text")))
    )


def with_clean_text(df: DataFrame) -> DataFrame:
    """Adds ``clean_text`` unless the frame brings its own."""
    return df if "clean_text" in df.columns else df.withColumn("clean_text", arabic.clean_text(F.col("text")))


def with_features(df: DataFrame) -> DataFrame:
    """Adds the five stylometric features of ``text``; no shuffle."""
    return df.withColumns(features(F.col("text")))


def prepare(df: DataFrame, clean: bool = True) -> DataFrame:
    """``with_clean_text`` (if ``clean``) and ``with_features`` by Arrow batches: the same columns and values.

    For training and scoring, which read every text and whose results have no SQL form. Plans of the other queries
    stay free of Python.
    """
    out = words.features(F.col("text"))
    if clean and "clean_text" not in df.columns:
        out = {"clean_text": words.clean_text(F.col("text")), **out}
    return df.withColumns(out)


def preview(df: DataFrame, key: str, rows: int, chars: int) -> DataFrame:
    """First rows by key, with long strings cut the way ``show`` cuts them."""
    cut = [
        F.when(F.length(name) > chars, F.concat(F.substring(name, 1, chars - 3), F.lit("...")))
        .otherwise(F.col(name))
        .alias(name)
        if kind == "string"
        else F.col(name)
        for name, kind in df.dtypes
    ]
    return df.orderBy(key).limit(rows).select(*cut)
