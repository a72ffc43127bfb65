"""Streaming aggregates: running metrics by key, and windows of event time.

The state store holds one row for each key, or for each open window, and survives a restart with the checkpoint.
Its size follows the keys, not the rows. Rows combine before the shuffle, so a hot key is a row for each task.

In update mode a micro-batch writes the rows that it changed as a version of its own, in place of what the same
batch wrote before a failure; the current table is the last version of each key. In complete mode each version is
the whole table, for few keys. Windows are also written in append mode, once, when the watermark closes them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from matnworks.operators.evaluation import confusion_matrix
from matnworks.streaming import progress


def keep_versions(rows: DataFrame, folder: str, mode: str = "update") -> StreamingQuery:
    """Aggregate what is available; every micro-batch writes its version of the rows."""

    def process(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/versions/batch_id={batch_id}")

    writer = (
        rows.writeStream.foreachBatch(process)
        .outputMode(mode)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
    )
    return progress.run(rows.sparkSession, writer, folder)


def current(spark: SparkSession, folder: str, *keys: str) -> DataFrame:
    """The last version of each key."""
    versions = spark.read.parquet(f"{folder}/versions")
    values = [c for c in versions.columns if c not in (*keys, "batch_id")]
    last = versions.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("last"))
    return last.select(*keys, "last.*")


def compact(spark: SparkSession, folder: str, *keys: str) -> int:
    """Merge all versions but the last into one; returns the number of versions that went.

    The last batch may not be committed yet and would then write its version again, so it is left alone. The merged
    rows are appended to the version before it, and older versions, which they cover, go after that: a failure at
    any point leaves the same current rows.
    """
    versions = spark.read.parquet(f"{folder}/versions")
    numbers = sorted(r.batch_id for r in versions.select("batch_id").distinct().collect())[:-1]
    if len(numbers) < 2:
        return 0
    values = [c for c in versions.columns if c not in (*keys, "batch_id")]
    last = versions.where(F.col("batch_id") <= numbers[-1]).groupBy(*keys)
    rows = last.agg(F.max_by(F.struct(*values), "batch_id").alias("last")).select(*keys, "last.*")
    rows.select(*[c for c in versions.columns if c != "batch_id"]).write.mode("append").parquet(
        f"{folder}/versions/batch_id={numbers[-1]}"
    )
    context = spark.sparkContext
    for number in numbers[:-1]:
        path = context._jvm.org.apache.hadoop.fs.Path(f"{folder}/versions/batch_id={number}")
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    return len(numbers) - 1


def running_counts(scored: DataFrame, key: str) -> DataFrame:
    """Confusion counts of a stream with ``label, prediction`` by ``key``, over all batches so far."""
    return confusion_matrix(scored, key)


def event_windows(
    events: DataFrame, time: str, width: str, late: str, *by: str, **aggregates: Column
) -> DataFrame:
    """``window_start, window_end``, the keys ``by``, ``n`` and further aggregates for each tumbling window.

    A window is closed, and leaves the state, in the batch after an event that is ``late`` or more past its end;
    from the next batch on its rows are dropped and counted in ``late_rows`` (as they are after their task combined
    them).
    Rows without a time belong to no window.
    """
    timed = events.where(F.col(time).isNotNull()).withWatermark(time, late)
    counted = timed.groupBy(F.window(time, width).alias("window"), *by).agg(
        F.count("*").alias("n"), *[column.alias(name) for name, column in aggregates.items()]
    )
    return counted.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *by,
        "n",
        *aggregates,
    )
