"""Text queries: cleaning, word and bigram statistics, TF-IDF terms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matnworks.functions import arabic
from matnworks.functions.tokens import raw_tokens
from matnworks.operators import tfidf, vocabulary
from matnworks.plans.shared_sql import CLEAN, CLEAN_BIGRAMS, CLEAN_WORDS, CONTENT, NORMALIZED, SPACE
from matnworks.registry import query
from matnworks.sources import files
from matnworks.sources.tables import (
    ar_documents,
    arabic_script,
    class_labels,
    documents,
    labelled,
    table,
)

@query("normalize_text", f"WITH {NORMALIZED} SELECT doc_id, normalized_text FROM normalized")
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ar_documents(spark, sf_dir).select(
        "doc_id", arabic.normalize(F.col("text")).alias("normalized_text")
    )


@query(
    "remove_stopwords",
    f"WITH {CONTENT} SELECT doc_id, array_to_string(words, ' ') AS no_stopwords_text FROM content",
)
def remove_stopwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    normalized = arabic.normalize(F.col("text"))
    return ar_documents(spark, sf_dir).select(
        "doc_id", arabic.remove_stopwords(normalized).alias("no_stopwords_text")
    )


# The affixes, stated a second time for the oracle.
@query(
    "light_stem",
    rf"""WITH {NORMALIZED},
        words AS (SELECT word, count(*) AS n
          FROM (SELECT unnest(string_split(normalized_text, ' ')) AS word FROM normalized)
          WHERE word <> '' GROUP BY word)
        SELECT word, n, regexp_replace(regexp_replace(word,
          '^(?:ال|وال|بال|كال|فال|لل|و|ف|ب|ك|ل|س)(.{{3,}})$', '\1'),
          '^(.{{3,}})(?:ها|هم|هن|كم|كن|نا|ون|ين|ان|ات|وا|ية)$', '\1') AS stem
        FROM words""",
)
def light_stem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stem of every distinct normalised word; each word is stemmed once, after counting."""
    words = F.array_remove(F.split(arabic.normalize(F.col("text")), " "), "")
    counts = vocabulary.word_count(ar_documents(spark, sf_dir), words)
    return counts.select(
        "word",
        F.col("count").alias("n"),
        F.get(arabic.stem_tokens(F.array("word")), F.lit(0)).alias("stem"),
    )


@query("clean_text", f"WITH {CLEAN} SELECT doc_id, array_to_string(stems, ' ') AS clean_text FROM clean")
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ar_documents(spark, sf_dir).select("doc_id", arabic.clean_text(F.col("text")).alias("clean_text"))


@query("word_count", f"WITH {CLEAN_WORDS} SELECT word, count(*) AS count FROM clean_words GROUP BY word")
def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocabulary.word_count(ar_documents(spark, sf_dir))


@query(
    "top_words",
    f"""WITH {CLEAN_WORDS} SELECT word, count(*) AS count FROM clean_words
        GROUP BY word ORDER BY count DESC, word LIMIT 20""",
)
def top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocabulary.top(vocabulary.word_count(ar_documents(spark, sf_dir)), "word", 20)


@query(
    "wordcloud_terms",
    f"""WITH {CLEAN_WORDS} SELECT word, count(*) AS count FROM clean_words
        GROUP BY word ORDER BY count DESC, word LIMIT 100""",
)
def wordcloud_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 100 most frequent words of the corpus."""
    return vocabulary.top(vocabulary.word_count(ar_documents(spark, sf_dir)), "word", 100)


@query(
    "bigram_count",
    f"WITH {CLEAN_BIGRAMS} SELECT bigram, count(*) AS count FROM clean_bigrams GROUP BY bigram",
)
def bigram_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocabulary.bigram_count(ar_documents(spark, sf_dir))


@query(
    "top_bigrams",
    f"""WITH {CLEAN_BIGRAMS} SELECT bigram, count(*) AS count FROM clean_bigrams
        GROUP BY bigram ORDER BY count DESC, bigram LIMIT 10""",
)
def top_bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocabulary.top(vocabulary.bigram_count(ar_documents(spark, sf_dir)), "bigram", 10)


@query(
    "report_bigrams",
    f"""WITH {CLEAN_BIGRAMS} SELECT bigram, count(*) AS count FROM clean_bigrams
        GROUP BY bigram ORDER BY count DESC, bigram LIMIT 15""",
)
def report_bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 15 most frequent bigrams of the corpus."""
    return vocabulary.top(vocabulary.bigram_count(ar_documents(spark, sf_dir)), "bigram", 15)


@query(
    "corpus_totals",
    f"""SELECT count(*) AS total_tokens, count(DISTINCT word) AS vocabulary
        FROM (SELECT unnest(regexp_extract_all(text, '[^{SPACE}]+')) AS word FROM documents)""",
)
def corpus_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens and distinct tokens of the raw texts."""
    return vocabulary.corpus_totals(vocabulary.word_count(documents(spark, sf_dir), raw_tokens(F.col("text"))))


def _sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored sketches of the words of each source and label; a document without label has none."""
    docs = documents(spark, sf_dir, "source").join(class_labels(spark, sf_dir), "doc_id", "left")
    return files.materialize(vocabulary.word_sketches(docs, raw_tokens(F.col("text")), "source", "label"), "sketches")


@query("approximate_vocabulary")
def approximate_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens and estimated vocabulary by source and label, by source, and of all, from one table of sketches."""
    stored = _sketches(spark, sf_dir)
    by_source = vocabulary.merge_sketches(stored, "source").withColumn("label", F.lit(None).cast("int"))
    whole = vocabulary.merge_sketches(stored).withColumn("source", F.lit(None).cast("string"))
    whole = whole.withColumn("label", F.lit(None).cast("int"))
    scopes = [stored.withColumn("scope", F.lit("source, label")), by_source.withColumn("scope", F.lit("source"))]
    rows = scopes[0].unionByName(scopes[1]).unionByName(whole.withColumn("scope", F.lit("all")))
    return vocabulary.estimated_vocabulary(rows)


@query(
    "approximate_vocabulary_check",
    f"""WITH w AS (SELECT source, unnest(regexp_extract_all(text, '[^{SPACE}]+')) AS word FROM documents)
        SELECT source, count(*) AS total_tokens, count(DISTINCT word) AS vocabulary, true AS near FROM w GROUP BY source""",
)
def approximate_vocabulary_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By source: tokens as the merged sketches count them, the exact vocabulary, and whether the estimate is within 3 %."""
    merged = vocabulary.estimated_vocabulary(vocabulary.merge_sketches(_sketches(spark, sf_dir), "source"))
    every = vocabulary.words(documents(spark, sf_dir, "source"), raw_tokens(F.col("text")), keep=("source",))
    exact = every.distinct().groupBy(F.col("source").alias("s")).agg(F.count("*").alias("vocabulary"))
    near = F.abs(F.col("approx_vocabulary") - F.col("vocabulary")) <= 0.03 * F.col("vocabulary")
    both = merged.join(exact, F.col("source").eqNullSafe(F.col("s")))
    return both.select("source", "total_tokens", "vocabulary", near.alias("near"))


@query(
    "ttr_by_label",
    f"""WITH {CLEAN_WORDS}
        SELECT quality AS label, count(*) AS tokens, count(DISTINCT word) AS types,
          round(count(DISTINCT word)::DOUBLE / count(*), 6) AS ttr
        FROM clean_words JOIN labels USING (doc_id) GROUP BY quality""",
)
def ttr_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = labelled(ar_documents(spark, sf_dir), class_labels(spark, sf_dir))
    return vocabulary.type_token_ratio(corpus).withColumn("ttr", F.round("ttr", 6))


@query(
    "hapax_ratio",
    f"""WITH {CLEAN_WORDS}, counts AS (SELECT word, count(*) AS n FROM clean_words GROUP BY word)
        SELECT CAST(sum(n) AS BIGINT) AS total_tokens, count(*) FILTER (n = 1) AS hapax_words,
          round((count(*) FILTER (n = 1))::DOUBLE / sum(n)::DOUBLE, 6) AS hapax_ratio
        FROM counts""",
)
def hapax_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = vocabulary.hapax_ratio(vocabulary.word_count(ar_documents(spark, sf_dir)))
    return out.withColumn("hapax_ratio", F.round("hapax_ratio", 6))


@query(
    "tfidf_terms",
    f"""WITH {CLEAN_WORDS},
        tf AS (SELECT doc_id, word AS term, count(*) AS tf FROM clean_words GROUP BY doc_id, word),
        freq AS (SELECT term, count(*) AS df FROM tf GROUP BY term)
        SELECT doc_id, term, tf, df, CASE WHEN df >= 3 THEN round(tf * ln(
          ((SELECT count(*) FROM documents) + 1)::DOUBLE / (df + 1)::DOUBLE), 6) ELSE 0 END AS tfidf
        FROM tf JOIN freq USING (term)""",
)
def tfidf_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = tfidf.tfidf(ar_documents(spark, sf_dir), arabic.clean_tokens(F.col("text")))
    return out.withColumn("tfidf", F.round("tfidf", 6))
