"""Corpus queries: ingest, profiles, previews and file round trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matnworks.fixed_values import PREVIEW_CHARS, PREVIEW_ROWS
from matnworks.operators import cleaning, profile, split
from matnworks.plans.shared_sql import BUCKET, CLEAN
from matnworks.registry import query
from matnworks.sources import files
from matnworks.sources.tables import (
    DOCUMENTS,
    ar_documents,
    class_labels,
    documents,
    labelled,
    spread,
    table,
)

CORPUS = """
corpus AS (
  SELECT doc_id, text, CAST(quality AS INT) AS label FROM documents JOIN labels USING (doc_id)
  WHERE text IS NOT NULL AND text <> '' AND quality IS NOT NULL)"""


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, text, label`` of the labelled documents."""
    return cleaning.clean_corpus(labelled(documents(spark, sf_dir), class_labels(spark, sf_dir)))


def corpus_keys(spark: SparkSession, sf_dir: str, *columns: Column) -> DataFrame:
    """``doc_id, label`` of the corpus and columns computed from its text.

    Text is filtered and measured at the scan, so the join moves only keys and numbers.
    """
    docs = table(spark, sf_dir, "documents").filter("text IS NOT NULL AND text <> ''")
    return labelled(docs.select("doc_id", *columns), class_labels(spark, sf_dir)).dropna(subset=["label"])


@query("clean_corpus", f"WITH {CORPUS} SELECT doc_id, text, label FROM corpus")
def clean_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus(spark, sf_dir).select("doc_id", "text", "label")


@query(
    "label_distribution",
    f"WITH {CORPUS} SELECT label, count(*) AS n FROM corpus GROUP BY label ORDER BY label",
)
def label_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.label_distribution(corpus_keys(spark, sf_dir))


@query(
    "length_summary",
    """SELECT count(length(text)) AS n, round(avg(length(text)), 6) AS mean,
         round(stddev_samp(length(text)), 6) AS stddev, min(length(text)) AS min, max(length(text)) AS max
       FROM documents""",
)
def length_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = profile.length_summary(table(spark, sf_dir, "documents"), F.length("text"))
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})


@query(
    "length_by_label",
    f"""WITH {CORPUS} SELECT label, count(*) AS n, round(avg(length(text)), 6) AS avg_len,
          round(stddev_samp(length(text)), 6) AS std_len
        FROM corpus GROUP BY label ORDER BY label""",
)
def length_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = profile.length_by_label(
        corpus_keys(spark, sf_dir, F.length("text").alias("chars")), F.col("chars")
    )
    return out.withColumns({c: F.round(c, 6) for c in ("avg_len", "std_len")})


@query(
    "null_profile",
    f"""WITH {CLEAN}
        SELECT count(*) FILTER (doc_id IS NULL) AS doc_id,
          count(*) FILTER (text IS NULL OR text = '') AS text,
          count(*) FILTER (quality IS NULL) AS label,
          count(*) FILTER (normalized_text = '') AS normalized_text,
          count(*) FILTER (len(words) = 0) AS no_stopwords_text,
          count(*) FILTER (len(stems) = 0) AS clean_text
        FROM clean LEFT JOIN labels USING (doc_id)""",
)
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing values of every column of the processed corpus, labels of unlabelled documents included."""
    docs = ar_documents(spark, sf_dir).join(class_labels(spark, sf_dir), "doc_id", "left")
    return profile.null_profile(cleaning.processed_corpus(docs))


@query(
    "processed_corpus",
    f"""WITH {CLEAN}
        SELECT doc_id, normalized_text, array_to_string(words, ' ') AS no_stopwords_text,
          array_to_string(stems, ' ') AS clean_text
        FROM clean""",
)
def processed_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three cleaned forms of every text."""
    return cleaning.processed_corpus(ar_documents(spark, sf_dir)).drop("text")


@query(
    "class_imbalance",
    f"""WITH {CORPUS}, counts AS (
          SELECT count(*) FILTER (label = 0) AS h, count(*) FILTER (label = 1) AS a FROM corpus)
        SELECT h AS count_human, a AS count_ai, round(h * 100.0::DOUBLE / (h + a), 6) AS pct_human,
          round(a * 100.0::DOUBLE / (h + a), 6) AS pct_ai,
          CASE WHEN h = 0 THEN 'inf'::DOUBLE ELSE round(a::DOUBLE / h, 6) END AS ratio
        FROM counts""",
)
def class_imbalance(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = profile.class_imbalance(corpus_keys(spark, sf_dir))
    return out.withColumns({c: F.round(c, 6) for c in ("pct_human", "pct_ai", "ratio")})


@query(
    "class_weights",
    f"""WITH {CORPUS}, train AS (SELECT label FROM corpus WHERE {BUCKET} < 70),
        counts AS (SELECT label, count(*) AS n FROM train GROUP BY label)
        SELECT label, coalesce(n, 0) AS n,
          coalesce(round((SELECT count(*) FROM train)::DOUBLE / (2 * n), 6), 1) AS weight
        FROM (VALUES (0), (1)) AS classes(label) LEFT JOIN counts USING (label)""",
)
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = split.take(corpus_keys(spark, sf_dir), "train")
    return profile.class_weights(train).withColumn("weight", F.round("weight", 6))


@query(
    "split_counts",
    f"""SELECT split, count(*) AS n FROM (
          SELECT CASE WHEN b < 70 THEN 'train' WHEN b < 85 THEN 'val' ELSE 'test' END AS split
          FROM (SELECT {BUCKET} AS b FROM documents))
        GROUP BY split""",
)
def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(split.split_name().alias("split"))
    return docs.groupBy("split").agg(F.count("*").alias("n"))


@query(
    "preview",
    """SELECT doc_id, CASE WHEN length(text) > 80 THEN substr(text, 1, 77) || '...' ELSE text END AS text,
         lang, source, n_chars
       FROM documents ORDER BY doc_id LIMIT 3""",
)
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return cleaning.preview(docs, "doc_id", PREVIEW_ROWS, PREVIEW_CHARS)


ALL_DOCUMENTS = "SELECT doc_id, text, lang, source, n_chars FROM documents"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*DOCUMENTS.names)
    return files.require_columns(docs, DOCUMENTS)


@query("csv_roundtrip", ALL_DOCUMENTS)
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = files.scratch(spark, "csv")
    files.write_csv(spread(_documents(spark, sf_dir), "doc_id"), path)
    return files.read_csv(spark, path, DOCUMENTS)


@query("parquet_roundtrip", ALL_DOCUMENTS)
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = _documents(spark, sf_dir), files.scratch(spark, "parquet")
    files.write_parquet(docs, path)
    written = spark.read.schema(DOCUMENTS).parquet(path)
    files.verify_written(docs, written)
    return written


@query("orc_roundtrip", ALL_DOCUMENTS)
def orc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = files.scratch(spark, "orc")
    files.write_orc(_documents(spark, sf_dir), path)
    return spark.read.schema(DOCUMENTS).orc(path)
