from collections import Counter

import plain
import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from matnworks.functions import arabic, stylometry, tokens
from matnworks.operators import cleaning, vocabulary

# text, normalised, clean, characters, digits, distinct marks, adjectives, genitives, gini
ROWS = [
    ("", "", "", 0, 0, 0, 0, 0, 0.0),
    ("   ", "", "", 3, 0, 0, 0, 0, 0.0),
    ("abc 123", "", "", 7, 3, 0, 0, 0, 0.0),
    (
        "كتب الطالب بحثا عن العلم في عام ٢٠٢٤.",
        "كتب الطالب بحثا عن العلم في عام ٢٠٢٤",
        "كتب طالب حثا علم عام ٢٠٢٤",
        37, 4, 1, 0, 2, 0.0,
    ),
    ("العَرَبي والعربي العربي", "العربي والعربي العربي", "عربي عربي عربي", 23, 0, 0, 2, 0, 0.0),
    ("من من إلى على مع", "من من الي علي مع", "الي علي", 16, 0, 0, 0, 4, 0.15),
    ("وَالكِتَابُ الـــجديد", "والكتاب الجديد", "كتاب جديد", 21, 0, 0, 0, 0, 0.0),
    ("مدرسة هدى؟ نعم، مدرسة!", "مدرسه هدي؟ نعم، مدرسه", "مدرسه هدي؟ نعم، مدرسه", 22, 0, 3, 0, 0, 0.0),
    ("والدي بيت البيوت", "والدي بيت البيوت", "الدي بيت بيوت", 16, 0, 0, 1, 0, 0.0),
    ('a"b\nسطر ثان', "سطر ثان", "سطر ثان", 11, 0, 1, 0, 0, 0.0),
]


@pytest.mark.parametrize("row", ROWS, ids=range(1, len(ROWS) + 1))
def test_hand_made_rows(spark, row):
    text, normalized, clean, chars, digits, marks, adjectives, genitives, gini = row
    df = spark.createDataFrame([(text,)], "text string")
    out = cleaning.with_features(cleaning.processed_corpus(df)).first()
    assert (out.normalized_text, out.clean_text) == (normalized, clean)
    assert out.f3_digits_ratio == (digits / chars if chars else 0.0)
    assert out.f24_punct_div == (marks / chars if chars else 0.0)
    assert (out.f45_adj_count, out.f66_genitive_count) == (adjectives, genitives)
    assert out.f87_gini == pytest.approx(gini, abs=1e-12)


def test_null_text_is_empty(spark):
    out = cleaning.with_features(
        cleaning.processed_corpus(spark.createDataFrame([(None,)], "text string"))
    ).first()
    assert (out.normalized_text, out.no_stopwords_text, out.clean_text) == ("", "", "")
    assert [out[c] for c in ("f3_digits_ratio", "f24_punct_div", "f45_adj_count", "f66_genitive_count", "f87_gini")] == [0.0] * 5


@pytest.fixture(scope="module")
def noisy(spark):
    texts = plain.random_texts(3000)
    return texts, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8).cache()


def test_cleaning_equals_plain_python(noisy):
    texts, df = noisy
    out = cleaning.processed_corpus(df).orderBy("doc_id").collect()
    for row, text in zip(out, texts):
        assert row.normalized_text == plain.normalize(text)
        assert row.no_stopwords_text == " ".join(plain.content(text))
        assert row.clean_text == plain.clean(text)


def test_features_equal_plain_python(noisy):
    texts, df = noisy
    out = cleaning.with_features(df).drop("text").orderBy("doc_id").collect()
    for row, text in zip(out, texts):
        assert tuple(row)[1:] == plain.features(text), text


def test_row_local_gini_equals_relational_gini(noisy):
    _, df = noisy
    counts = (
        df.select("doc_id", F.explode(tokens.raw_tokens(F.col("text"))).alias("w"))
        .groupBy("doc_id", "w")
        .agg(F.count("*").alias("f"))
    )
    ranked = counts.withColumn("i", F.row_number().over(Window.partitionBy("doc_id").orderBy("f", "w")))
    n, mass = F.count("*"), F.sum("f")
    relational = ranked.groupBy("doc_id").agg(
        (F.sum(F.col("i") * F.col("f")) * 2 / (n * mass) - (n + 1) / n).alias("expected")
    )
    local = df.select("doc_id", stylometry.gini(tokens.raw_tokens(F.col("text"))).alias("gini"))
    both = local.join(relational, "doc_id", "left")
    assert both.filter(F.abs(F.col("gini") - F.coalesce("expected", F.lit(0.0))) > 1e-12).count() == 0


def test_run_counts_equal_counter(noisy):
    texts, df = noisy
    out = df.select("doc_id", tokens.run_counts(tokens.raw_tokens(F.col("text"))).alias("c"))
    for row in out.orderBy("doc_id").collect():
        assert {x.word: x.n for x in row.c} == Counter(texts[row.doc_id].split())


def test_stopwords_can_be_normalised_and_replaced(spark):
    df = spark.createDataFrame([("من إلى على كتاب",)], "text string")
    n = arabic.normalize(F.col("text"))
    row = df.select(
        arabic.remove_stopwords(n).alias("as_is"),
        arabic.remove_stopwords(n, normalize_stopwords=True).alias("normalised"),
        arabic.remove_stopwords(n, stopwords=["كتاب"]).alias("own"),
    ).first()
    assert tuple(row) == ("الي علي كتاب", "كتاب", "من الي علي")


@pytest.mark.parametrize("text,expected", [("", []), ("a", []), ("a b", ["a b"]), ("a b a", ["a b", "b a"])])
def test_bigrams(spark, text, expected):
    df = spark.createDataFrame([(text,)], "text string")
    assert df.select(tokens.bigrams(tokens.raw_tokens(F.col("text"))).alias("b")).first().b == expected


def test_extended_features_of_a_small_text(spark):
    df = spark.createDataFrame([("aa b aa. كِ! ",), ("",)], "text string")
    some, empty = [r.x for r in df.select(stylometry.extended_features(F.col("text")).alias("x")).collect()]
    # tokens: aa, b, aa., كِ!  -> lengths 2, 1, 3, 3; two sentences hold a non-space character
    assert (some.char_count, some.word_count, some.avg_word_len) == (13, 4, 2.25)
    assert (some.ttr, some.hapax_ratio, some.avg_sent_len) == (1.0, 1.0, 2.0)
    assert some.word_len_var == pytest.approx(0.6875)
    assert some.diacritic_ratio == pytest.approx(1 / 13)
    assert tuple(empty) == (0, 0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0)


def test_a_long_document_is_processed_whole(spark):
    words = [f"w{i % 5000}" for i in range(200_000)]
    text = " ".join(words)
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = df.select(
        stylometry.gini(tokens.raw_tokens(F.col("text"))).alias("g"),
        F.size(tokens.raw_tokens(F.col("text"))).alias("n"),
    ).first()
    assert row.n == 200_000
    assert row.g == pytest.approx(plain.gini(text), abs=1e-12)


def test_vocabulary_statistics(spark):
    df = spark.createDataFrame(
        [(1, 0, "كتاب كتاب بيت"), (2, 1, "بيت درس"), (3, 1, "")], "doc_id long, label int, text string"
    )
    counts = vocabulary.word_count(df)
    expected = Counter(w for r in df.collect() for w in plain.clean(r.text).split())
    assert {r.word: r["count"] for r in counts.collect()} == expected
    hapax = vocabulary.hapax_ratio(counts).first()
    assert (hapax.total_tokens, hapax.hapax_words) == (5, 1)
    ttr = {r.label: (r.tokens, r.types) for r in vocabulary.type_token_ratio(df).collect()}
    assert ttr == {0: (3, 2), 1: (2, 2)}
    approx = vocabulary.approximate_totals(df, arabic.clean_tokens(F.col("text"))).first()
    assert tuple(approx) == (5, 3)


def test_statistics_of_an_empty_corpus(spark):
    df = spark.createDataFrame([(1, "")], "doc_id long, text string")
    counts = vocabulary.word_count(df)
    assert tuple(vocabulary.hapax_ratio(counts).first()) == (0, 0, None)
    assert tuple(vocabulary.corpus_totals(counts).first()) == (0, 0)


def test_doc_id_from_text_is_stable(spark):
    df = spark.createDataFrame([("a",), ("b",)], "text string")
    once = {r.text: r.doc_id for r in cleaning.with_doc_id(df).collect()}
    again = {r.text: r.doc_id for r in cleaning.with_doc_id(df.repartition(3)).collect()}
    assert once == again
    assert cleaning.with_doc_id(df.withColumn("doc_id", F.lit(1))).first().doc_id == 1
