"""Classification metrics from counts that are aggregated in Spark.

Predictions are reduced to four counts per group in one pass; all metrics are arithmetic on those
counts. Rows with a null label or prediction are left out of the metrics and counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matnworks.sources.files import materialize

COUNTS = ("TP", "TN", "FP", "FN")


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def confusion_matrix(df: DataFrame, *by: str) -> DataFrame:
    """``TP, TN, FP, FN``, predictions per class and ``n_unlabelled``, over all rows or by group."""
    label, prediction = F.col("label"), F.col("prediction")

    def cell(actual: int, predicted: int) -> Column:
        return F.count_if((label == actual) & (prediction == predicted))

    return df.groupBy(*by).agg(
        cell(1, 1).alias("TP"),
        cell(0, 0).alias("TN"),
        cell(0, 1).alias("FP"),
        cell(1, 0).alias("FN"),
        F.count_if(prediction == 0).alias("predicted_human"),
        F.count_if(prediction == 1).alias("predicted_ai"),
        F.count_if(label.isNull() | prediction.isNull()).alias("n_unlabelled"),
    )


def metrics() -> dict[str, Column]:
    """Metric expressions over the columns of ``confusion_matrix``."""
    tp, tn, fp, fn = (F.col(c) for c in COUNTS)
    n = tp + tn + fp + fn
    out = {"n_records": n, "accuracy": _ratio(tp + tn, n)}
    for name, hit, false_hit, miss in (("human", tn, fn, fp), ("ai", tp, fp, fn)):
        precision, recall = _ratio(hit, hit + false_hit), _ratio(hit, hit + miss)
        out[f"{name}_precision"] = precision
        out[f"{name}_recall"] = recall
        out[f"{name}_f1"] = _ratio(F.lit(2.0) * precision * recall, precision + recall)
    share = {"human": _ratio(tn + fp, n), "ai": _ratio(tp + fn, n)}
    for metric in ("precision", "recall", "f1"):
        out[metric] = share["human"] * out[f"human_{metric}"] + share["ai"] * out[f"ai_{metric}"]
    return out


def evaluate(df: DataFrame, *by: str) -> DataFrame:
    """Accuracy and weighted precision, recall and F1."""
    m = metrics()
    wanted = ("n_records", "accuracy", "precision", "recall", "f1")
    return confusion_matrix(df, *by).select(*by, *[m[name].alias(name) for name in wanted])


def evaluate_per_class(df: DataFrame) -> DataFrame:
    """``label, precision, recall, f1``: one row per class, 0 where undefined."""
    m = metrics()
    wide = confusion_matrix(df).select(
        *[m[f"{c}_{x}"].alias(f"{c}_{x}") for c in ("human", "ai") for x in ("precision", "recall", "f1")]
    )
    return wide.select(
        F.expr(
            "stack(2, 0, human_precision, human_recall, human_f1, 1, ai_precision, ai_recall, ai_f1)"
            " AS (label, precision, recall, f1)"
        )
    )


def evaluation_table(df: DataFrame, *by: str) -> DataFrame:
    """All metrics and the confusion counts in one row per group."""
    m = metrics()
    return confusion_matrix(df, *by).select(
        *by,
        *[m[x].alias(x) for x in ("accuracy", "precision", "recall", "f1")],
        *COUNTS,
        m["human_f1"].alias("human_f1"),
        m["ai_f1"].alias("ai_f1"),
    )


def roc_auc(df: DataFrame, score: str) -> DataFrame:
    """Exact area under the ROC curve with ties at half weight; 0 if a class is missing.

    Equal scores are merged first, so a score that many rows share is one row. The merged scores are
    dealt into ranges, as many as the session has shuffle partitions, and ranked within each; the ranges
    add up by a prefix sum over one row for each. They are written with their range, because a second
    pass must meet the same ranges.
    """
    counted = df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col("label") == 1).cast("double").alias("pos"),
        F.count_if(F.col("label") == 0).cast("double").alias("neg"),
    )
    ranged = counted.where("score IS NOT NULL").repartitionByRange("score").withColumn("part", F.spark_partition_id())
    tied = materialize(ranged, "scores")
    below = F.sum("neg").over(
        Window.partitionBy("part").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    )
    per_part = (
        tied.withColumn("below", F.coalesce(below, F.lit(0.0)))
        .groupBy("part")
        .agg(
            F.sum("pos").alias("pos"),
            F.sum("neg").alias("neg"),
            F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2)).alias("wins"),
        )
    )
    # One row per range from here on.
    earlier = F.sum("neg").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    wins = F.col("wins") + F.col("pos") * F.coalesce("earlier", F.lit(0.0))
    return (
        per_part.withColumn("earlier", earlier)
        .agg(F.sum(wins).alias("wins"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .select(
            F.coalesce(F.try_divide(F.col("wins"), F.col("pos") * F.col("neg")), F.lit(0.0)).alias("auc")
        )
    )


def best_model(results: DataFrame) -> DataFrame:
    """The row with the highest F1, first by name on ties."""
    return results.orderBy(F.desc("f1"), "model").limit(1)
