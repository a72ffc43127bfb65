"""File streams in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from matnworks.sources import files
from matnworks.sources.files import CSV_READ
from matnworks.streaming import progress


def csv_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    files_per_trigger: int | None = None,
    bytes_per_trigger: int = 1 << 30,
) -> DataFrame:
    """CSV files of a folder as a stream, with an explicit schema and a bound for each micro-batch."""
    reader = spark.readStream.schema(schema).options(**CSV_READ)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    else:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    return reader.csv(path)


def append_parquet(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write what is available to a file sink. Each row arrives once, also after a restart."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def quarantine_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    folder: str,
    files_per_trigger: int | None = None,
    header: bool = True,
) -> StreamingQuery:
    """Land CSV files: rows that fit the schema go to ``folder``/good, the others with a reason to ``folder``/bad.

    A micro-batch is read and parsed once and replaces its own partition of both tables, so a batch that is
    repeated after a failure between the two writes leaves every row once.
    """
    reader = spark.readStream.schema(files.raw_schema(schema)).options(**files.RAW_READ).option("header", header)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    else:
        reader = reader.option("maxBytesPerTrigger", 1 << 30)

    def process(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            files.well_formed(held, schema).write.mode("overwrite").parquet(f"{folder}/good/batch_id={batch_id}")
            files.malformed(held, schema).write.mode("overwrite").parquet(f"{folder}/bad/batch_id={batch_id}")
        finally:
            held.unpersist()

    writer = reader.csv(path).writeStream.foreachBatch(process).trigger(availableNow=True)
    return progress.run(spark, writer.option("checkpointLocation", f"{folder}/checkpoint"), folder)
