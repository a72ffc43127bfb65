"""Stylometric features of one document as row-local column expressions.

No feature needs a shuffle: the word-frequency features work on the token array of the row, so the
same expressions serve batch frames and streams.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from matnworks.fixed_values import PUNCTUATION
from matnworks.functions import patterns
from matnworks.functions.tokens import bind, frequencies, raw_tokens, total


def _share(part: Column, whole: Column) -> Column:
    """part / whole as double, 0 for an empty whole."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def count_matches(text: Column, pattern: str) -> Column:
    """Matches of a pattern, as the number of cuts it makes.

    Splitting is linear in the text. ``regexp_count`` keeps a copy of the whole text for every match,
    which is quadratic in long documents with many matches.
    """
    return F.size(F.split(F.coalesce(text, F.lit("")), pattern)) - 1


def digit_ratio(text: Column) -> Column:
    return _share(count_matches(text, patterns.DIGIT), F.length(text))


def punctuation_diversity(text: Column) -> Column:
    """Distinct punctuation marks per character."""
    present = sum((text.contains(mark).cast("int") for mark in PUNCTUATION), F.lit(0))
    return _share(present, F.length(text))


def adjective_count(text: Column) -> Column:
    return count_matches(text, patterns.ADJECTIVE).cast("double")


def genitive_count(text: Column) -> Column:
    return count_matches(text, patterns.GENITIVE).cast("double")


def gini(tokens: Column) -> Column:
    """Gini coefficient of the word frequencies: 2*sum(i*f_i)/(n*F) - (n+1)/n over ascending f."""

    def coefficient(f: Column) -> Column:
        n = F.size(f).cast("double")
        weighted = total(F.transform(f, lambda x, i: (i + 1).cast("bigint") * x))
        mass = total(f)
        return F.when(
            F.size(f) > 0,
            (weighted * 2).cast("double") / (F.size(f).cast("bigint") * mass).cast("double") - (n + 1) / n,
        ).otherwise(F.lit(0.0))

    return F.coalesce(bind(frequencies(tokens), coefficient), F.lit(0.0))


def features(text: Column) -> dict[str, Column]:
    """The five features, by column name."""
    return {
        "f3_digits_ratio": digit_ratio(text),
        "f24_punct_div": punctuation_diversity(text),
        "f45_adj_count": adjective_count(text),
        "f66_genitive_count": genitive_count(text),
        "f87_gini": gini(raw_tokens(text)),
    }


def extended_features(text: Column) -> Column:
    """Struct of the further document statistics: counts, word lengths, type and hapax ratios."""
    chars = F.length(F.coalesce(text, F.lit("")))
    sentences = F.greatest(
        F.lit(1),
        F.size(
            F.filter(
                F.split(F.coalesce(text, F.lit("")), patterns.SENTENCE_END),
                lambda s: s.rlike(patterns.NON_SPACE),
            )
        ),
    )

    def describe(words: Column) -> Column:
        n = F.size(words).cast("bigint")
        lengths = F.transform(words, lambda w: F.length(w).cast("bigint"))
        letters = total(lengths)
        squares = total(F.transform(words, lambda w: (F.length(w) * F.length(w)).cast("bigint")))
        return bind(
            frequencies(words),
            lambda f: F.struct(
                chars.cast("bigint").alias("char_count"),
                n.alias("word_count"),
                _share(letters, n).alias("avg_word_len"),
                _share(F.size(f), n).alias("ttr"),
                _share(F.size(F.filter(f, lambda x: x == 1)), n).alias("hapax_ratio"),
                _share(n * squares - letters * letters, n * n).alias("word_len_var"),
                _share(n, sentences).alias("avg_sent_len"),
                _share(count_matches(text, patterns.DIACRITIC), chars).alias("diacritic_ratio"),
            ),
        )

    return bind(raw_tokens(text), describe)
