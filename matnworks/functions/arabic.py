"""Arabic text cleaning as column expressions: normalise, drop stop words, light-stem.

Everything here is row-local and runs in the JVM; a null text is treated as the empty string.
Letters are mapped with one ``translate`` and words are stemmed with ``CASE`` expressions: chains of
``regexp_replace`` cost about twice as much for the same result.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from matnworks.fixed_values import STEM_MIN_LENGTH, STEM_PREFIXES, STEM_SUFFIXES, STOPWORDS
from matnworks.functions import patterns

# Letters that are unified, and marks (diacritics and tatweel) that are removed.
UNIFIED_FROM = "إأآٱةى"
UNIFIED_TO = "ااااهي"
REMOVED = "".join(map(chr, [*range(0x064B, 0x0660), 0x0670, 0x0640]))


def unify_letters(text: Column) -> Column:
    """Strip marks and tatweel and unify letter variants."""
    return F.translate(F.coalesce(text, F.lit("")), UNIFIED_FROM + REMOVED, UNIFIED_TO)


def normalize(text: Column) -> Column:
    """Unified letters, with every run of non-Arabic characters turned into one space."""
    return F.trim(F.regexp_replace(unify_letters(text), patterns.NON_ARABIC_RUN, " "))


def normalized_stopwords(stopwords: Iterable[str] = STOPWORDS) -> list[str]:
    """The list in normalised spelling, so that entries with hamza or alef maqsura can match."""
    return sorted({w.translate(str.maketrans(UNIFIED_FROM, UNIFIED_TO)) for w in stopwords})


def _content(words: Column, stopwords: Iterable[str], normalize_stopwords: bool) -> Column:
    drop = normalized_stopwords(stopwords) if normalize_stopwords else list(stopwords)
    return F.filter(words, lambda w: (F.length(w) > 1) & ~w.isin(drop))


def remove_stopwords(
    normalized: Column, stopwords: Iterable[str] = STOPWORDS, normalize_stopwords: bool = False
) -> Column:
    """A normalised text without stop words and one-character tokens."""
    words = F.split(F.coalesce(normalized, F.lit("")), " ")
    return F.array_join(_content(words, stopwords, normalize_stopwords), " ")


def strip_prefix(word: Column) -> Column:
    """Without the first prefix that leaves enough of the word."""
    out = F
    for prefix in STEM_PREFIXES:
        fits = word.startswith(prefix) & (F.length(word) >= len(prefix) + STEM_MIN_LENGTH)
        out = out.when(fits, F.substr(word, F.lit(len(prefix) + 1)))
    return out.otherwise(word)


def strip_suffix(word: Column) -> Column:
    """Without its suffix, if enough of the word remains. All suffixes have the same length."""
    (size,) = {len(s) for s in STEM_SUFFIXES}
    fits = (F.length(word) >= size + STEM_MIN_LENGTH) & F.right(word, F.lit(size)).isin(STEM_SUFFIXES)
    return F.when(fits, F.left(word, F.length(word) - size)).otherwise(word)


def stem_tokens(words: Column) -> Column:
    """Light stems of a token array."""
    return F.transform(F.transform(words, strip_prefix), strip_suffix)


def stem_text(cleaned: Column) -> Column:
    """A stop-word-free text with every word stemmed."""
    return F.array_join(stem_tokens(F.split(cleaned, " ")), " ")


def clean_tokens(
    text: Column, stopwords: Iterable[str] = STOPWORDS, normalize_stopwords: bool = False
) -> Column:
    """Normalised, stop-word-free, stemmed tokens of a raw text."""
    words = F.split(unify_letters(text), patterns.NON_ARABIC_RUN)
    return stem_tokens(_content(words, stopwords, normalize_stopwords))


def clean_text(text: Column, **options) -> Column:
    return F.array_join(clean_tokens(text, **options), " ")
