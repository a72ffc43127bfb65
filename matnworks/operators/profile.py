"""Corpus profiles: one aggregation pass each, with map-side partial aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def label_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("label").agg(F.count("*").alias("n")).orderBy("label")


def length_summary(df: DataFrame, size: Column) -> DataFrame:
    """Count, mean, sample standard deviation, minimum and maximum of a length."""
    return df.agg(
        F.count(size).alias("n"),
        F.avg(size).alias("mean"),
        F.stddev_samp(size).alias("stddev"),
        F.min(size).cast("bigint").alias("min"),
        F.max(size).cast("bigint").alias("max"),
    )


def length_by_label(df: DataFrame, size: Column) -> DataFrame:
    """Count, mean and sample standard deviation of a length for each label."""
    return (
        df.groupBy("label")
        .agg(F.count("*").alias("n"), F.avg(size).alias("avg_len"), F.stddev_samp(size).alias("std_len"))
        .orderBy("label")
    )


def null_profile(df: DataFrame) -> DataFrame:
    """One row with the number of missing values of each column: null, empty string or NaN."""

    def missing(name: str, kind: str) -> Column:
        absent = F.col(name).isNull()
        if kind == "string":
            absent |= F.col(name) == ""
        elif kind in ("float", "double"):
            absent |= F.isnan(name)
        return F.count_if(absent).alias(name)

    return df.agg(*[missing(name, kind) for name, kind in df.dtypes])


def class_imbalance(df: DataFrame) -> DataFrame:
    """Class counts, percentages and the AI:human ratio (infinite without human rows)."""
    human, ai = F.col("count_human"), F.col("count_ai")
    return df.agg(
        F.count_if(F.col("label") == 0).alias("count_human"),
        F.count_if(F.col("label") == 1).alias("count_ai"),
    ).select(
        human,
        ai,
        F.try_divide(human * F.lit(100.0), human + ai).alias("pct_human"),
        F.try_divide(ai * F.lit(100.0), human + ai).alias("pct_ai"),
        F.when(human == 0, F.lit(float("inf"))).otherwise(F.try_divide(ai, human)).alias("ratio"),
    )


def class_weights(df: DataFrame) -> DataFrame:
    """``label, n, weight`` with the balanced weight total / (2 n). At most one row per class."""
    one_row = df.agg(
        F.count_if(F.col("label") == 0).alias("n0"),
        F.count_if(F.col("label") == 1).alias("n1"),
        F.count("*").alias("total"),
    )
    balanced = F.try_divide(F.col("total").cast("double"), F.lit(2.0) * F.col("n"))
    return one_row.select(
        "total", F.expr("stack(2, 0, n0, 1, n1) AS (label, n)")
    ).select("label", "n", F.coalesce(balanced, F.lit(1.0)).alias("weight"))


def with_class_weight(df: DataFrame) -> DataFrame:
    """Adds ``classWeight`` from the frame's own class counts. Two weights are broadcast."""
    weights = class_weights(df).select(
        F.col("label").cast(dict(df.dtypes)["label"]).alias("label"), F.col("weight").alias("classWeight")
    )
    return df.join(F.broadcast(weights), "label")
