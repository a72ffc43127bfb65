"""Word and bigram statistics.

Every count is exploded and grouped by the word, so frequent words are combined before the shuffle
and no word list or text reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matnworks.functions.arabic import clean_tokens
from matnworks.functions.tokens import bigrams


def words(df: DataFrame, tokens: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per token of the cleaned text, or of another token array."""
    array = clean_tokens(F.col("text")) if tokens is None else tokens
    return df.select(*keep, F.explode(array).alias("word"))


def word_count(df: DataFrame, tokens: Column | None = None) -> DataFrame:
    return words(df, tokens).groupBy("word").agg(F.count("*").alias("count"))


def bigram_count(df: DataFrame) -> DataFrame:
    pairs = df.select(F.explode(bigrams(clean_tokens(F.col("text")))).alias("bigram"))
    return pairs.groupBy("bigram").agg(F.count("*").alias("count"))


def top(counts: DataFrame, key: str, k: int) -> DataFrame:
    """The k most frequent keys, ties by key. Each task keeps k rows."""
    return counts.orderBy(F.desc("count"), key).limit(k)


def corpus_totals(counts: DataFrame) -> DataFrame:
    """Tokens and vocabulary size from word counts."""
    return counts.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("total_tokens"), F.count("*").alias("vocabulary")
    )


def approximate_totals(df: DataFrame, tokens: Column, rsd: float = 0.01) -> DataFrame:
    """Tokens, and an estimate of the vocabulary size that needs no shuffle of words."""
    return words(df, tokens).agg(
        F.count("*").alias("total_tokens"),
        F.approx_count_distinct("word", rsd).alias("approx_vocabulary"),
    )


def type_token_ratio(df: DataFrame) -> DataFrame:
    """Tokens, types and their ratio for each label; 0 for a label whose texts have no tokens.

    Grouping by (label, word) first spreads a label that holds most of the corpus over all tasks.
    """
    per_word = (
        df.select("label", F.explode_outer(clean_tokens(F.col("text"))).alias("word"))
        .groupBy("label", "word")
        .agg(F.count("word").alias("n"))
    )
    return (
        per_word.groupBy("label")
        .agg(F.sum("n").alias("tokens"), F.count("word").alias("types"))
        .withColumn("ttr", F.coalesce(F.try_divide("types", "tokens"), F.lit(0.0)))
        .orderBy("label")
    )


def hapax_ratio(counts: DataFrame) -> DataFrame:
    """Words seen once in the corpus, as a share of all tokens."""
    return counts.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("total_tokens"),
        F.count_if(F.col("count") == 1).alias("hapax_words"),
    ).withColumn("hapax_ratio", F.try_divide("hapax_words", "total_tokens"))


def word_sketches(df: DataFrame, tokens: Column, *by: str, precision: int = 14) -> DataFrame:
    """Tokens, and a HyperLogLog sketch of the different words, for each group.

    A sketch has at most ``2 ** precision`` bytes whatever the text, so it can be stored and merged with those of
    other groups or later data; no word leaves its task. The relative standard error is 1.04 / sqrt(2 ** precision),
    0.8 % by default.
    """
    return words(df, tokens, keep=by).groupBy(*by).agg(
        F.count("*").alias("total_tokens"), F.hll_sketch_agg("word", precision).alias("sketch")
    )


def merge_sketches(sketches: DataFrame, *by: str) -> DataFrame:
    """Sketches of larger groups; words that several groups share count once."""
    return sketches.groupBy(*by).agg(
        F.coalesce(F.sum("total_tokens"), F.lit(0)).alias("total_tokens"), F.hll_union_agg("sketch").alias("sketch")
    )


def estimated_vocabulary(sketches: DataFrame) -> DataFrame:
    """The sketches replaced by the estimate of their number of words."""
    estimate = F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0).cast("long"))
    return sketches.withColumn("approx_vocabulary", estimate).drop("sketch")
