"""Continuous scoring with metrics for each batch.

A micro-batch is scored once into its own partition of the scored table, then reduced to confusion
counts. Both writes replace the partition of that batch id, so a batch that is repeated after a
failure leaves one result. Counts can be added up, so metrics by batch or key come from the counts
table and the stream keeps no state. Latency is the engine's: from asking the source to the commit.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from matnworks.operators.evaluation import confusion_matrix, metrics
from matnworks.streaming import progress

SUMMED = ("TP", "TN", "FP", "FN", "predicted_human", "predicted_ai", "n_unlabelled")


def score_stream(
    stream: DataFrame, score: Callable[[DataFrame], DataFrame], folder: str, key: str | None = None
) -> StreamingQuery:
    """Score what is available. ``score`` must return at least ``doc_id, label, prediction``.

    The counts table has one row for each micro-batch, or for each value of ``key`` in it: a column of
    few values such as the delivery that a row came with.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        partition = f"batch_id={batch_id}"
        score(batch).write.mode("overwrite").parquet(f"{folder}/scored/{partition}")
        rows = batch.sparkSession.read.parquet(f"{folder}/scored/{partition}")
        counts = confusion_matrix(rows, *([key] if key else []))
        counts.write.mode("overwrite").parquet(f"{folder}/counts/{partition}")

    writer = (
        stream.writeStream.foreachBatch(process)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
    )
    return progress.run(stream.sparkSession, writer, folder)


def scored_rows(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/scored")


def rounded(counts: DataFrame, key: str) -> DataFrame:
    m = metrics()
    return counts.select(
        F.col(key).cast("bigint").alias("batch"),
        m["n_records"].alias("n_records"),
        *[F.round(m[x], 4).alias(x) for x in ("accuracy", "f1")],
        "predicted_human",
        "predicted_ai",
        *[F.round(m[x], 4).alias(x) for x in ("human_recall", "ai_recall")],
        *[c for c in ("latency_ms", "throughput_rps") if c in counts.columns],
    )


def key_metrics(spark: SparkSession, folder: str, key: str) -> DataFrame:
    """Metrics for each value of the key, however its rows were split into micro-batches."""
    counts = spark.read.parquet(f"{folder}/counts")
    return rounded(counts.groupBy(key).agg(*[F.sum(c).alias(c) for c in SUMMED]), key)


def batch_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics of each micro-batch, with its latency and the rows a second that its source delivered.

    Latency is null for a batch whose driver died between its commit and the next write of times.
    """
    counts = spark.read.parquet(f"{folder}/counts")
    totals = counts.groupBy("batch_id").agg(*[F.sum(c).alias(c) for c in SUMMED])
    times = progress.batch_times(spark, folder).select(
        "batch_id",
        F.col("trigger_ms").cast("double").alias("latency_ms"),
        F.round(F.col("input_rows") * 1000 / F.col("trigger_ms"), 1).alias("throughput_rps"),
    )
    totals = totals.join(times, "batch_id", "left")
    return rounded(totals, "batch_id")


def stream_summary(per_batch: DataFrame) -> DataFrame:
    """Number of batches and the mean of each metric over them."""
    measured = ("accuracy", "f1", "human_recall", "ai_recall", "latency_ms", "throughput_rps")
    present = [c for c in measured if c in per_batch.columns]
    return per_batch.agg(F.count("*").alias("batches"), *[F.avg(c).alias(f"avg_{c}") for c in present])
