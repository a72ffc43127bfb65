"""Feature reports by label and the fixed linear scorer."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matnworks.fixed_values import COEFFICIENTS, FEATURES


def feature_means(df: DataFrame) -> DataFrame:
    """Mean of each feature for each label, in one aggregation."""
    short = {name: f"avg_{name.split('_')[0]}" for name in FEATURES}
    return df.groupBy("label").agg(*[F.avg(name).alias(out) for name, out in short.items()]).orderBy("label")


def gini_by_label(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("label")
        .agg(F.avg("f87_gini").alias("avg_f87"), F.stddev_samp("f87_gini").alias("std_f87"))
        .orderBy("label")
    )


def _long_means(df: DataFrame) -> DataFrame:
    """``feature, human, ai``: unrounded means, 0 for a label without rows."""
    means = df.groupBy("label").agg(*[F.avg(name).alias(name) for name in FEATURES])
    long = means.unpivot("label", list(FEATURES), "feature", "mean")
    wide = long.groupBy("feature").pivot("label", [0, 1]).agg(F.first("mean"))
    return wide.select(
        "feature",
        F.coalesce("0", F.lit(0.0)).alias("human"),
        F.coalesce("1", F.lit(0.0)).alias("ai"),
    )


def feature_summary(df: DataFrame) -> DataFrame:
    """Means by label and their difference, one row per feature, 6 decimals.

    The means of all features but the Gini coefficient are rounded before the difference is taken.
    """
    late = F.col("feature") == "f87_gini"
    human, ai = F.round("human", 6), F.round("ai", 6)
    difference = F.when(late, F.col("ai") - F.col("human")).otherwise(ai - human)
    names = F.create_map(*[F.lit(x) for pair in FEATURES.items() for x in pair])
    return _long_means(df).select(
        "feature",
        names[F.col("feature")].alias("description"),
        human.alias("human_mean"),
        ai.alias("ai_mean"),
        F.round(difference, 6).alias("difference"),
    )


def linear_margin(coefficients: Mapping[str, float] = COEFFICIENTS) -> Column:
    """Sum of coefficient times feature, in feature order, rounded so that zero is well defined.

    It is declared free of nulls: a null check on it would be pushed below the features and compute
    them a second time.
    """
    terms = [F.col(name) * F.lit(float(coefficients[name])) for name in FEATURES]
    return F.coalesce(F.round(sum(terms[1:], terms[0]), 6), F.lit(0.0))


def score_linear(df: DataFrame, coefficients: Mapping[str, float] = COEFFICIENTS) -> DataFrame:
    """Adds ``margin`` and ``prediction`` of the fixed linear model. Row-local."""
    return df.withColumn("margin", linear_margin(coefficients)).withColumn(
        "prediction", (F.col("margin") > 0).cast("int")
    )


def coefficient_rank(df: DataFrame, coefficients: Mapping[str, float] = COEFFICIENTS) -> DataFrame:
    """Features by absolute coefficient, each with its mean contribution to the margin by label."""
    weight = F.create_map(*[F.lit(x) for pair in coefficients.items() for x in pair])[F.col("feature")]
    return (
        _long_means(df)
        .select(
            "feature",
            weight.alias("cofficient"),
            F.abs(weight).alias("abs_coef"),
            F.round(weight * F.col("human"), 6).alias("human_contribution"),
            F.round(weight * F.col("ai"), 6).alias("ai_contribution"),
        )
        .orderBy(F.desc("abs_coef"))
    )


def error_sample(scored: DataFrame, rows: int, chars: int) -> DataFrame:
    """The first misclassified documents, with the beginning of their text."""
    return (
        scored.filter(F.col("label") != F.col("prediction"))
        .orderBy("doc_id")
        .limit(rows)
        .select("doc_id", "label", "prediction", F.substring("text", 1, chars).alias("sample_text"))
    )
