"""The training-data pipeline: documents to packed sequences.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage before it kept; ``run`` writes
each result as Parquet to the shared folder and reads it again for the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matnworks.llm import decontamination, lines, neardup, packing, quality, rows
from matnworks.llm.queries import tokenizer
from matnworks.sources import files
from matnworks.sources.tables import table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the boilerplate lines of its source."""
    kept = lines.drop_boilerplate(docs, host="source", counts=False)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, a similarity of 0.8 or more.

    Rows without id take part. Of rows that repeat id and text the first by all columns stays.
    """
    key, place = rows.fresh(docs, "key"), rows.fresh(docs, "place")
    found = neardup.groups(docs, shingle=5, percent=80).where("stays").select(F.col("row").alias(key)).distinct()
    kept = docs.withColumn(key, rows.row_key()).join(found, key, "left_semi")
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    first = F.row_number().over(Window.partitionBy(key).orderBy(*others or [F.col(key)]))
    return kept.withColumn(place, first).where(F.col(place) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word window of a benchmark item."""
    key = rows.fresh(docs, "key")
    found = decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"), window=10)
    gone = found.where("contaminated").select(F.col("row").alias(key))
    return docs.withColumn(key, rows.row_key()).join(gone, key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences of at most 1024 tokens."""
    return packing.pack(docs, *tokenizer())


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("near dedup", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# Components of near-duplicates and token ids are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = files.materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
