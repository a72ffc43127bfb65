"""Streaming queries over the documents table."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matnworks.fixed_values import FEATURES
from matnworks.operators import cleaning, models, reports
from matnworks.plans.authorship import ROUNDED
from matnworks.plans.learning import prepared_documents, training_corpus
from matnworks.plans.shared_sql import FEATURES as FEATURES_SQL
from matnworks.plans.shared_sql import SCORED
from matnworks.registry import query
from matnworks.sources import files
from matnworks.sources.tables import ar_documents, class_labels, document_stream, labelled, table
from matnworks.streaming import ingest, progress, scoring, stateful

NAMES = list(FEATURES)

STREAM_ROWS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("label", T.DoubleType()),
        *[T.StructField(name, T.DoubleType()) for name in NAMES],
    ]
)


@query(
    "stream_ingest",
    f"""WITH {FEATURES_SQL} SELECT doc_id, text, quality::DOUBLE AS label, {ROUNDED}
        FROM features JOIN ar_documents USING (doc_id) JOIN labels USING (doc_id)""",
)
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with features land as CSV files, are read as a stream and appended to a Parquet table."""
    folder = files.scratch(spark, "ingest")
    corpus = labelled(ar_documents(spark, sf_dir), class_labels(spark, sf_dir))
    rows = cleaning.with_features(corpus).select(
        "doc_id", "text", F.col("label").cast("double").alias("label"), *NAMES
    )
    files.write_csv(rows, f"{folder}/landing")
    stream = ingest.csv_stream(spark, f"{folder}/landing", STREAM_ROWS, files_per_trigger=4)
    ingest.append_parquet(stream, f"{folder}/table", f"{folder}/checkpoint")
    out = spark.read.schema(STREAM_ROWS).parquet(f"{folder}/table")
    return out.withColumns({name: F.round(name, 6) for name in NAMES})


@query("stream_features", f"WITH {FEATURES_SQL} SELECT doc_id, {ROUNDED} FROM features")
def stream_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch feature expressions on a stream; they are row-local, so there is no state."""
    folder = files.scratch(spark, "features")
    stream = cleaning.with_features(document_stream(spark, sf_dir)).drop("text")
    ingest.append_parquet(stream, f"{folder}/table", f"{folder}/checkpoint")
    out = spark.read.schema(stream.schema).parquet(f"{folder}/table")
    return out.withColumns({name: F.round(name, 6) for name in NAMES})


LANDED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("label", T.IntegerType()),
        T.StructField("batch", T.LongType()),
        T.StructField("part", T.IntegerType()),
    ]
)
DELIVERIES = 10
ROWS_PER_FILE = 100_000


def files_per_delivery(rows: int, cores: int) -> int:
    """One file for each core where a file gets a hundred rows, and never more than ``ROWS_PER_FILE`` rows in one."""
    each = rows // DELIVERIES
    return max(1, -(-each // ROWS_PER_FILE), min(cores, each // 100))


def _landed_stream(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """A fixture: all documents, with their label if they have one, as files that are read in ten micro-batches.

    The files of a delivery are written by as many tasks and read by as many, so no delivery is one task.
    """
    parts = files_per_delivery(table(spark, sf_dir, "documents").count(), spark.sparkContext.defaultParallelism)
    docs = ar_documents(spark, sf_dir).join(class_labels(spark, sf_dir), "doc_id", "left")
    batch = F.pmod("doc_id", F.lit(DELIVERIES)).cast("long").alias("batch")
    part = F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int").alias("part")
    rows = docs.select("doc_id", "text", "label", batch, part).repartition(DELIVERIES * parts, "batch", "part")
    rows.write.partitionBy("batch", "part").parquet(f"{folder}/landing")
    return spark.readStream.schema(LANDED).option("maxFilesPerTrigger", parts).parquet(f"{folder}/landing")


def _linear_stream(spark: SparkSession, sf_dir: str) -> str:
    """Score documents as they arrive; returns the folder of results."""
    folder = files.scratch(spark, "scores")

    def score(batch: DataFrame) -> DataFrame:
        scored = reports.score_linear(cleaning.prepare(batch, clean=False))
        return scored.select("doc_id", "text", "label", "batch", "margin", "prediction")

    scoring.score_stream(_landed_stream(spark, sf_dir, folder), score, folder, key="batch")
    return folder


ALL_SCORED = SCORED.replace("JOIN labels l", "LEFT JOIN labels l")


@query(
    "stream_linear_scores",
    f"WITH {ALL_SCORED} SELECT doc_id, text, label, margin, prediction FROM scored JOIN ar_documents USING (doc_id)",
)
def stream_linear_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _linear_stream(spark, sf_dir)
    return scoring.scored_rows(spark, folder).select("doc_id", "text", "label", "margin", "prediction")


def batches_sql(key: str) -> str:
    """Metrics of the linear scores for each value of an expression over ``doc_id``."""
    return f"""{ALL_SCORED},
counts AS (
  SELECT {key} AS batch, count(label) AS n, count(*) FILTER (prediction = 0) AS predicted_human,
    count(*) FILTER (prediction = 1) AS predicted_ai,
    (count(*) FILTER (label = 0 AND prediction = 0))::DOUBLE AS tn,
    (count(*) FILTER (label = 1 AND prediction = 1))::DOUBLE AS tp,
    (count(*) FILTER (label = 0 AND prediction = 1))::DOUBLE AS fp,
    (count(*) FILTER (label = 1 AND prediction = 0))::DOUBLE AS fn
  FROM scored GROUP BY {key}),
batches AS (
  SELECT batch, n AS n_records, coalesce(round((tp + tn) / nullif(n, 0), 4), 0) AS accuracy,
    coalesce(round((tn + fp) / nullif(n, 0) * coalesce(2 * tn / nullif(2 * tn + fp + fn, 0), 0)
      + (tp + fn) / nullif(n, 0) * coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 4), 0) AS f1,
    predicted_human, predicted_ai, round(coalesce(tn / nullif(tn + fp, 0), 0), 4) AS human_recall,
    round(coalesce(tp / nullif(tp + fn, 0), 0), 4) AS ai_recall
  FROM counts)"""


BATCHES = batches_sql(f"doc_id % {DELIVERIES}")


@query("stream_batch_metrics", f"WITH {BATCHES} SELECT * FROM batches")
def stream_batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.key_metrics(spark, _linear_stream(spark, sf_dir), "batch")


@query(
    "stream_summary",
    f"""WITH {BATCHES} SELECT count(*) AS batches, round(avg(accuracy), 6) AS avg_accuracy,
          round(avg(f1), 6) AS avg_f1, round(avg(human_recall), 6) AS avg_human_recall,
          round(avg(ai_recall), 6) AS avg_ai_recall FROM batches""",
)
def stream_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scoring.stream_summary(scoring.key_metrics(spark, _linear_stream(spark, sf_dir), "batch"))
    return out.withColumns({c: F.round(c, 6) for c in out.columns if c != "batches"})


@query("stream_latency")
def stream_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of each micro-batch with its latency and the parts of it. Wall-clock values have no oracle."""
    folder = _linear_stream(spark, sf_dir)
    times = progress.batch_times(spark, folder).withColumnRenamed("batch_id", "batch")
    parts = times.select("batch", "source_ms", "planning_ms", "add_batch_ms", "commit_ms")
    return scoring.batch_metrics(spark, folder).join(parts, "batch", "left")


@query(
    "stream_latency_check",
    f"""SELECT count(DISTINCT doc_id % {DELIVERIES}) AS batches, count(quality) AS labelled, count(*) AS scored,
          0::BIGINT AS without_latency FROM documents LEFT JOIN labels USING (doc_id)""",
)
def stream_latency_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-batches, their labelled and scored rows, and batches without a measured latency."""
    return stream_latency(spark, sf_dir).agg(
        F.count("*").alias("batches"),
        F.sum("n_records").alias("labelled"),
        F.sum(F.col("predicted_human") + F.col("predicted_ai")).alias("scored"),
        F.count_if(F.expr("NOT latency_ms > 0 OR NOT throughput_rps > 0")).alias("without_latency"),
    )


def _model_stream(spark: SparkSession, sf_dir: str, model: PipelineModel) -> DataFrame:
    folder = files.scratch(spark, "model-scores")

    def score(batch: DataFrame) -> DataFrame:
        scored = model.transform(cleaning.prepare(batch))
        return scored.select("doc_id", "text", "label", "batch", F.col("prediction").cast("int"))

    scoring.score_stream(_landed_stream(spark, sf_dir, folder), score, folder, key="batch")
    return scoring.scored_rows(spark, folder).select("doc_id", "text", "label", "prediction")


def _logistic(spark: SparkSession, sf_dir: str) -> PipelineModel:
    return models.fit_models(models.training_table(training_corpus(spark, sf_dir)), "lr")["lr"]


@query("stream_scores")
def stream_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents scored by the trained logistic model as they arrive."""
    return _model_stream(spark, sf_dir, _logistic(spark, sf_dir))


@query("stream_scores_check", "SELECT count(*) AS scored, 0::BIGINT AS different FROM documents")
def stream_scores_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that the stream scored, and those that the same model scores otherwise in a batch."""
    model = _logistic(spark, sf_dir)
    batch = model.transform(prepared_documents(spark, sf_dir)).select("doc_id", F.col("prediction").alias("in_batch"))
    both = _model_stream(spark, sf_dir, model).join(batch, "doc_id", "left")
    return both.agg(
        F.count("*").alias("scored"), F.count_if(F.expr("NOT prediction <=> CAST(in_batch AS INT)")).alias("different")
    )


DELIVERED = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType()), T.StructField("lang", T.StringType())]
)
# Faults by id: a number that is none, a field too few, a field too many.
FAULTY_SQL = """
WITH d AS (SELECT doc_id, n_chars, lang, doc_id % 13 AS fault FROM documents)
SELECT doc_id, n_chars, lang, NULL AS record, NULL AS reason FROM d WHERE fault NOT IN (1, 2, 3)
UNION ALL
SELECT NULL, NULL, NULL, CASE fault WHEN 1 THEN concat(doc_id, ',x', n_chars, ',', lang) WHEN 2 THEN concat(doc_id, ',', n_chars)
    ELSE concat(doc_id, ',', n_chars, ',', lang, ',more') END, CASE fault WHEN 1 THEN 'n_chars' ELSE 'record' END
FROM d WHERE fault IN (1, 2, 3)
"""


def _faulty_folder(spark: SparkSession, sf_dir: str) -> str:
    """Some columns of the documents as CSV, with faulty records among them."""
    folder = files.scratch(spark, "faulty")
    fault, parts = F.col("doc_id") % 13, [F.col("doc_id"), F.col("n_chars"), F.col("lang")]
    line = (
        F.when(fault == 1, F.concat("doc_id", F.lit(",x"), "n_chars", F.lit(","), "lang"))
        .when(fault == 2, F.concat_ws(",", *parts[:2]))
        .when(fault == 3, F.concat_ws(",", *parts, F.lit("more")))
        .otherwise(F.concat_ws(",", *parts))
    )
    rows = table(spark, sf_dir, "documents").repartition(4, "doc_id").select(line.alias("value"))
    rows.write.text(f"{folder}/landing")
    return folder


def _sorted_out(good: DataFrame, bad: DataFrame) -> DataFrame:
    typed = good.select("doc_id", "n_chars", "lang").withColumns({c: F.lit(None).cast("string") for c in ("record", "reason")})
    return typed.unionByName(bad.select("record", "reason"), allowMissingColumns=True)


@query("quarantine_csv", FAULTY_SQL)
def quarantine_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good rows with their types, faulty records with the reason, from one batch read."""
    folder = _faulty_folder(spark, sf_dir)
    raw = files.materialize(files.read_raw_csv(spark, f"{folder}/landing", DELIVERED, header=False), "raw")
    return _sorted_out(files.well_formed(raw, DELIVERED), files.malformed(raw, DELIVERED))


@query("quarantine_stream", FAULTY_SQL)
def quarantine_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows from a stream of files with two sinks."""
    folder = _faulty_folder(spark, sf_dir)
    ingest.quarantine_stream(spark, f"{folder}/landing", DELIVERED, folder, files_per_trigger=2, header=False)
    return _sorted_out(spark.read.parquet(f"{folder}/good"), spark.read.parquet(f"{folder}/bad"))


CHUNKS = 50


@query("stream_state_metrics", f"WITH {batches_sql(f'doc_id // {DELIVERIES} % {CHUNKS}')} SELECT * FROM batches")
def stream_state_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running metrics of chunks that every delivery adds to, from counts in the state of the stream."""
    folder = files.scratch(spark, "state")
    chunk = F.expr(f"doc_id div {DELIVERIES} % {CHUNKS}").alias("batch")
    scored = reports.score_linear(cleaning.prepare(_landed_stream(spark, sf_dir, folder), clean=False))
    counts = stateful.running_counts(scored.select(chunk, "label", "prediction"), "batch")
    stateful.keep_versions(counts, folder)
    return scoring.rounded(stateful.current(spark, folder, "batch"), "batch")


EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


@query(
    "stream_event_windows",
    """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
         strftime(date_trunc('hour', ts) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end,
         event_type, count(*) AS n, max(value) AS max_value, count(value) AS n_values
       FROM events WHERE ts IS NOT NULL GROUP BY ALL""",
)
def stream_event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of each hour and type from a stream with a watermark of a day."""
    folder = files.scratch(spark, "windows")
    # The pattern lets the table be one file or a folder; a plain stream path must be a folder.
    events = spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/events.parque[t]")
    counted = stateful.event_windows(
        events.withColumn("ts", F.col("ts").cast("timestamp")),
        "ts",
        "1 hour",
        "1 day",
        "event_type",
        max_value=F.max("value"),
        n_values=F.count("value"),
    )
    stateful.keep_versions(counted, folder)
    shown = [F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("window_start", "window_end")]
    rows = stateful.current(spark, folder, "window_start", "window_end", "event_type")
    return rows.select(*shown, "event_type", "n", "max_value", "n_values")
