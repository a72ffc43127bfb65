"""The given tables and the corpus frames built from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)

# The transliteration that gives the Latin test corpus an Arabic script.
ARABIC_WORDS = {
    " the ": " في ",
    " of ": " من ",
    " and ": " إلى ",
    " is ": " كان ",
    " to ": " على ",
    " that ": " الذي ",
    " by ": " العلمي ",
}
LATIN_LETTERS = "abcdefghijklmnopqrstuvwxyz,?;"
ARABIC_LETTERS = "اببدييغلنةأتمنوسـراسوّآخهى،؟؛"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def is_narrow(df: DataFrame) -> bool:
    """Whether a scan has fewer splits than the cluster has cores."""
    return df.rdd.getNumPartitions() < df.sparkSession.sparkContext.defaultParallelism


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give every core a share of a scan that has fewer splits than the cluster has cores.

    A file with one row group is one task however large the cluster is, and text functions are
    CPU-bound. A scan with enough splits is returned as it is, so large inputs are not shuffled.
    """
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, key) if is_narrow(df) else df


def arabic_script(text: Column) -> Column:
    out = F.lower(text)
    for latin, arabic in ARABIC_WORDS.items():
        out = F.replace(out, F.lit(latin), F.lit(arabic))
    return F.translate(out, LATIN_LETTERS, ARABIC_LETTERS)


def documents(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """``doc_id, text`` of the raw corpus, and further columns of the table on request."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text", *more), "doc_id")


def ar_documents(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """``doc_id, text`` in Arabic script."""
    return documents(spark, sf_dir, *more).withColumn("text", arabic_script(F.col("text")))


def class_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, label``, one row per labelled document."""
    return table(spark, sf_dir, "labels").select(
        "doc_id", F.col("quality").try_cast("int").alias("label")
    )


def document_stream(
    spark: SparkSession, sf_dir: str, files_per_trigger: int | None = None, bytes_per_trigger: int = 1 << 30
) -> DataFrame:
    """``doc_id, text`` in Arabic script as a stream over the files of the documents table.

    A micro-batch is bounded by files or by bytes, so a large backlog is many batches.
    """
    reader = spark.readStream.schema(DOCUMENTS)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    else:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    # The pattern lets the table be one file or a folder; a plain stream path must be a folder.
    stream = reader.parquet(f"{sf_dir}/documents.parque[t]").select("doc_id", "text")
    return stream.withColumn("text", arabic_script(F.col("text")))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Inner join on ``doc_id``. The side to broadcast, if any, is left to the size statistics."""
    return docs.join(labels, "doc_id")
