"""Stylometric features, their reports and the evaluation of deterministic scorers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matnworks.fixed_values import ERROR_SAMPLE_ROWS, ERROR_TEXT_CHARS, FEATURES
from matnworks.functions.stylometry import extended_features as extended
from matnworks.operators import cleaning, evaluation, reports
from matnworks.plans.shared_sql import (
    AR_DOCUMENTS,
    CONFUSION,
    FEATURES as FEATURES_SQL,
    LABELLED_FEATURES,
    SCORED,
    SPACE,
)
from matnworks.registry import query
from matnworks.sources.tables import ar_documents, class_labels, labelled

NAMES = list(FEATURES)
ROUNDED = ", ".join(f"round({name}, 6) AS {name}" for name in NAMES)


def feature_table(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """``doc_id`` and features. The text ends here, so later joins move only numbers."""
    return cleaning.with_features(ar_documents(spark, sf_dir, *more)).drop("text")


def labelled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(feature_table(spark, sf_dir), class_labels(spark, sf_dir))


def scored(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """``doc_id, label, margin, prediction`` of the fixed linear scorer."""
    margins = reports.score_linear(feature_table(spark, sf_dir, *more)).drop(*NAMES)
    return labelled(margins, class_labels(spark, sf_dir))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query("stylometric_features", f"WITH {FEATURES_SQL} SELECT doc_id, {ROUNDED} FROM features")
def stylometric_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(feature_table(spark, sf_dir), *NAMES)


@query(
    "extended_features",
    rf"""WITH {AR_DOCUMENTS},
        t AS (SELECT doc_id, text, regexp_extract_all(text, '[^{SPACE}]+') AS w,
            greatest(1, len(list_filter(regexp_split_to_array(text, '[.!?؟]+'),
              lambda s: regexp_matches(s, '[^{SPACE}]')))) AS sentences,
            len(regexp_extract_all(text, '[\x{{064B}}-\x{{065F}}\x{{0670}}]')) AS marks
          FROM ar_documents),
        words AS (SELECT doc_id, unnest(w) AS word FROM t),
        counts AS (SELECT doc_id, word, count(*) AS n FROM words GROUP BY doc_id, word),
        types AS (SELECT doc_id, count(*) AS types, count(*) FILTER (n = 1) AS hapax FROM counts GROUP BY doc_id),
        lengths AS (SELECT doc_id, avg(length(word)) AS mean, var_pop(length(word)) AS var FROM words GROUP BY doc_id)
        SELECT doc_id, length(text) AS char_count, len(w) AS word_count,
          coalesce(round(mean, 6), 0) AS avg_word_len,
          coalesce(round(types::DOUBLE / len(w), 6), 0) AS ttr,
          coalesce(round(hapax::DOUBLE / len(w), 6), 0) AS hapax_ratio,
          coalesce(round(var, 6), 0) AS word_len_var,
          round(len(w)::DOUBLE / sentences, 6) AS avg_sent_len,
          coalesce(round(marks::DOUBLE / nullif(length(text), 0), 6), 0) AS diacritic_ratio
        FROM t LEFT JOIN types USING (doc_id) LEFT JOIN lengths USING (doc_id)""",
)
def extended_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ar_documents(spark, sf_dir).select("doc_id", extended(F.col("text")).alias("x")).select("doc_id", "x.*")
    return _rounded(out, *[name for name, kind in out.dtypes if kind == "double"])


MEANS = ", ".join(f"round(avg({name}), 6) AS avg_{name.split('_')[0]}" for name in NAMES)


@query(
    "feature_means_by_label",
    f"WITH {LABELLED_FEATURES} SELECT label, {MEANS} FROM labelled GROUP BY label ORDER BY label",
)
def feature_means_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = reports.feature_means(labelled_features(spark, sf_dir))
    return _rounded(out, *[c for c in out.columns if c != "label"])


@query(
    "gini_by_label",
    f"""WITH {LABELLED_FEATURES} SELECT label, round(avg(f87_gini), 6) AS avg_f87,
          round(stddev_samp(f87_gini), 6) AS std_f87 FROM labelled GROUP BY label""",
)
def gini_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(reports.gini_by_label(labelled_features(spark, sf_dir)), "avg_f87", "std_f87")


LONG_MEANS = f"""{LABELLED_FEATURES},
long AS (SELECT doc_id, label, feature, value FROM labelled UNPIVOT (value FOR feature IN ({", ".join(NAMES)}))),
means AS (
  SELECT feature, coalesce(avg(value) FILTER (label = 0), 0) AS human,
    coalesce(avg(value) FILTER (label = 1), 0) AS ai
  FROM long GROUP BY feature)"""


@query(
    "feature_summary",
    f"""WITH {LONG_MEANS}
        SELECT feature, CASE feature WHEN 'f3_digits_ratio' THEN 'f3  - digits/C'
            WHEN 'f24_punct_div' THEN 'f24 - punct/C' WHEN 'f45_adj_count' THEN 'f45 - adjectives'
            WHEN 'f66_genitive_count' THEN 'f66 - genitives' ELSE 'f87 - Gini coeff' END AS description,
          round(human, 6) AS human_mean, round(ai, 6) AS ai_mean,
          round(CASE feature WHEN 'f87_gini' THEN ai - human ELSE round(ai, 6) - round(human, 6) END, 6)
            AS difference
        FROM means""",
)
def feature_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.feature_summary(labelled_features(spark, sf_dir))


# The published coefficients, stated a second time for the oracle.
@query(
    "coefficient_rank",
    f"""WITH {LONG_MEANS}, coefficients(feature, c) AS (VALUES
          ('f24_punct_div', CAST(-58.637206 AS DOUBLE)), ('f3_digits_ratio', CAST(5.037039 AS DOUBLE)),
          ('f87_gini', CAST(1.110944 AS DOUBLE)), ('f66_genitive_count', CAST(0.024537 AS DOUBLE)),
          ('f45_adj_count', CAST(-0.003263 AS DOUBLE)))
        SELECT feature, c AS cofficient, abs(c) AS abs_coef, round(c * human, 6) AS human_contribution,
          round(c * ai, 6) AS ai_contribution
        FROM means JOIN coefficients USING (feature) ORDER BY abs_coef DESC""",
)
def coefficient_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.coefficient_rank(labelled_features(spark, sf_dir))


@query("score_linear", f"WITH {SCORED} SELECT doc_id, label, margin, prediction FROM scored")
def score_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).select("doc_id", "label", "margin", "prediction")


@query(
    "error_sample",
    f"""WITH {SCORED} SELECT doc_id, label, prediction, substr(text, 1, 300) AS sample_text
        FROM scored JOIN ar_documents USING (doc_id)
        WHERE label <> prediction ORDER BY doc_id LIMIT 5""",
)
def error_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the beginning of each text, which is all the report shows, travels with the features."""
    head = F.substring("text", 1, ERROR_TEXT_CHARS).alias("text")
    docs = cleaning.with_features(ar_documents(spark, sf_dir)).select("doc_id", head, *NAMES)
    margins = labelled(reports.score_linear(docs), class_labels(spark, sf_dir))
    return reports.error_sample(margins, ERROR_SAMPLE_ROWS, ERROR_TEXT_CHARS)


@query(
    "confusion_matrix",
    f"""WITH {SCORED}, {CONFUSION}
        SELECT tp::BIGINT AS "TP", tn::BIGINT AS "TN", fp::BIGINT AS "FP", fn::BIGINT AS "FN" FROM confusion""",
)
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.confusion_matrix(scored(spark, sf_dir)).select(*evaluation.COUNTS)


PER_CLASS = f"""{SCORED}, {CONFUSION},
per_class AS (
  SELECT label, share, coalesce(hit / nullif(hit + false_hit, 0), 0) AS precision,
    coalesce(hit / nullif(hit + miss, 0), 0) AS recall
  FROM (SELECT 0 AS label, (tn + fp) / n AS share, tn AS hit, fn AS false_hit, fp AS miss FROM confusion
        UNION ALL SELECT 1, (tp + fn) / n, tp, fp, fn FROM confusion)),
with_f1 AS (
  SELECT *, coalesce(CAST(2 AS DOUBLE) * precision * recall / nullif(precision + recall, 0), 0) AS f1
  FROM per_class)"""


@query(
    "eval_weighted",
    f"""WITH {PER_CLASS}
        SELECT (SELECT n::BIGINT FROM confusion) AS n_records,
          round((SELECT (tp + tn) / n FROM confusion), 6) AS accuracy,
          round(sum(share * precision), 6) AS precision, round(sum(share * recall), 6) AS recall,
          round(sum(share * f1), 6) AS f1
        FROM with_f1""",
)
def eval_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluation.evaluate(scored(spark, sf_dir)), "accuracy", "precision", "recall", "f1")


@query(
    "eval_per_class",
    f"""WITH {PER_CLASS} SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall,
          round(f1, 6) AS f1 FROM with_f1""",
)
def eval_per_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluation.evaluate_per_class(scored(spark, sf_dir)), "precision", "recall", "f1")


@query(
    "eval_auc",
    f"""WITH {SCORED}, ranked AS (
          SELECT label, rank() OVER (ORDER BY margin) + (count(*) OVER (PARTITION BY margin) - 1) / 2.0::DOUBLE AS r
          FROM scored)
        SELECT round((sum(r) FILTER (label = 1) - p * (p + 1) / 2) / (p * n), 6) AS auc
        FROM ranked, (SELECT (count(*) FILTER (label = 1))::DOUBLE AS p,
          (count(*) FILTER (label = 0))::DOUBLE AS n FROM scored)
        GROUP BY p, n""",
)
def eval_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(evaluation.roc_auc(scored(spark, sf_dir), "margin"), "auc")


@query(
    "best_model",
    f"""WITH {SCORED}, rules AS (
          SELECT 'linear margin' AS model, label, prediction FROM scored
          UNION ALL SELECT 'text length', quality, (n_chars >= 1000)::INT FROM documents JOIN labels USING (doc_id)
          UNION ALL SELECT 'always ai', quality, 1 FROM documents JOIN labels USING (doc_id)),
        counts AS (
          SELECT model, c AS class, count(*) FILTER (label = c)::DOUBLE AS actual,
            count(*) FILTER (prediction = c)::DOUBLE AS predicted,
            count(*) FILTER (label = c AND prediction = c)::DOUBLE AS hit, count(*)::DOUBLE AS n
          FROM rules, (VALUES (0), (1)) AS classes(c) GROUP BY model, c)
        SELECT model, round(sum(hit) / any_value(n), 6) AS accuracy,
          round(sum(actual / n * coalesce(2 * hit / nullif(actual + predicted, 0), 0)), 6) AS f1
        FROM counts GROUP BY model ORDER BY f1 DESC, model LIMIT 1""",
)
def best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best of three rules by weighted F1: the linear scorer, a length rule, the majority class."""
    rules = scored(spark, sf_dir, "n_chars").select(
        "label",
        F.col("prediction").alias("linear margin"),
        (F.col("n_chars") >= 1000).cast("int").alias("text length"),
        F.lit(1).alias("always ai"),
    )
    names = ["linear margin", "text length", "always ai"]
    long = rules.unpivot("label", names, "model", "prediction")
    results = _rounded(evaluation.evaluate(long, "model"), "accuracy", "f1")
    return evaluation.best_model(results).select("model", "accuracy", "f1")
