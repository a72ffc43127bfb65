import pytest
from pyspark.sql import functions as F

from matnworks.operators import cleaning, models, reports
from matnworks.plans.learning import training_corpus
from matnworks.sources.files import write_parquet
from matnworks.sources.tables import ar_documents, class_labels, labelled
from matnworks.streaming import ingest, scoring

SCHEMA = "doc_id long, text string, label int"


@pytest.fixture(scope="module")
def corpus(spark, sf_dir):
    return labelled(ar_documents(spark, sf_dir), class_labels(spark, sf_dir)).cache()


def score(batch):
    scored = reports.score_linear(cleaning.with_features(batch))
    return scored.select("doc_id", "text", "label", "prediction", (F.col("doc_id") % 3).alias("delivery"))


def stream(spark, path, files_per_trigger=1):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


@pytest.fixture()
def landed(corpus, tmp_path):
    """Five files, so five micro-batches; chunks of ids are spread over all of them."""
    path = str(tmp_path / "in")
    write_parquet(corpus.repartition(5, "doc_id"), path)
    return path


def rows(df):
    return sorted(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


def test_stream_equals_batch(spark, corpus, landed, tmp_path):
    folder = str(tmp_path / "out")
    query = scoring.score_stream(stream(spark, landed), score, folder)
    assert len([p for p in query.recentProgress if p.numInputRows]) == 5
    scored = scoring.scored_rows(spark, folder)
    assert scored.select("batch_id").distinct().count() == 5
    assert rows(scored.drop("batch_id")) == rows(score(corpus))


def test_metrics_do_not_depend_on_the_micro_batches(spark, landed, tmp_path):
    results = []
    for files_per_trigger in (1, 2, 5):
        folder = str(tmp_path / f"out{files_per_trigger}")
        scoring.score_stream(stream(spark, landed, files_per_trigger), score, folder, key="delivery")
        results.append(rows(scoring.key_metrics(spark, folder, "delivery")))
    assert results[0] == results[1] == results[2]


def test_restart_adds_only_new_files(spark, corpus, landed, tmp_path):
    folder = str(tmp_path / "out")
    scoring.score_stream(stream(spark, landed), score, folder)
    before = rows(scoring.scored_rows(spark, folder))
    scoring.score_stream(stream(spark, landed), score, folder)
    assert rows(scoring.scored_rows(spark, folder)) == before
    more = corpus.limit(3).withColumn("doc_id", F.col("doc_id") + 10_000)
    more.coalesce(1).write.mode("append").parquet(landed)
    scoring.score_stream(stream(spark, landed), score, folder)
    assert len(rows(scoring.scored_rows(spark, folder))) == len(before) + 3


def test_repeated_batch_replaces_itself(spark, landed, tmp_path):
    """A batch that fails after its scores were written is run again and counted once."""
    folder = str(tmp_path / "out")
    calls = []

    def fails_once(batch):
        calls.append(1)
        if len(calls) == 2:
            score(batch).write.mode("overwrite").parquet(f"{folder}/scored/batch_id=1")
            raise RuntimeError("lost")
        return score(batch)

    with pytest.raises(Exception, match="lost"):
        scoring.score_stream(stream(spark, landed), fails_once, folder)
    scoring.score_stream(stream(spark, landed), fails_once, folder)
    clean = str(tmp_path / "clean")
    scoring.score_stream(stream(spark, landed), score, clean)
    counts = lambda at: rows(scoring.batch_metrics(spark, at).drop("latency_ms", "throughput_rps"))
    assert counts(folder) == counts(clean)
    assert spark.read.parquet(f"{folder}/counts").count() == 5
    assert scoring.scored_rows(spark, folder).count() == scoring.scored_rows(spark, clean).count()


def test_batch_metrics(spark, corpus, landed, tmp_path):
    folder = str(tmp_path / "out")
    scoring.score_stream(stream(spark, landed), score, folder)
    per_batch = scoring.batch_metrics(spark, folder)
    out = per_batch.collect()
    assert per_batch.columns == [
        "batch", "n_records", "accuracy", "f1", "predicted_human", "predicted_ai", "human_recall",
        "ai_recall", "latency_ms", "throughput_rps",
    ]
    assert sorted(r.batch for r in out) == [0, 1, 2, 3, 4]
    assert sum(r.n_records for r in out) == corpus.count()
    assert all(r.latency_ms > 0 and r.throughput_rps > 0 for r in out)
    summary = scoring.stream_summary(per_batch).first()
    assert summary.batches == 5
    assert summary.avg_f1 == pytest.approx(sum(r.f1 for r in out) / 5)


def test_null_labels_are_scored_but_not_measured(spark, corpus, tmp_path):
    path, folder = str(tmp_path / "in"), str(tmp_path / "out")
    unlabelled = corpus.withColumn("label", F.when(F.col("doc_id") % 2 == 0, F.col("label")))
    write_parquet(unlabelled.coalesce(1), path)
    scoring.score_stream(stream(spark, path), score, folder)
    assert scoring.scored_rows(spark, folder).count() == corpus.count()
    measured = scoring.batch_metrics(spark, folder).first()
    assert measured.n_records == corpus.filter(F.col("doc_id") % 2 == 0).count()
    assert measured.predicted_human + measured.predicted_ai == corpus.count()


def test_features_on_a_stream_equal_batch_features(spark, corpus, landed, tmp_path):
    out, checkpoint = str(tmp_path / "table"), str(tmp_path / "cp")
    ingest.append_parquet(cleaning.with_features(stream(spark, landed)), out, checkpoint)
    assert rows(spark.read.parquet(out)) == rows(cleaning.with_features(corpus))
    ingest.append_parquet(cleaning.with_features(stream(spark, landed)), out, checkpoint)
    assert spark.read.parquet(out).count() == corpus.count()


def test_fitted_pipeline_scores_a_stream(spark, sf_dir, corpus, landed, tmp_path):
    """The pipeline that was fitted in batch transforms a streaming frame as it is."""
    table = models.training_table(training_corpus(spark, sf_dir))
    model = models.fit_models(table, "lr")["lr"]

    def scores(df):
        return model.transform(cleaning.with_features(cleaning.with_clean_text(df))).select("doc_id", "prediction")

    out = str(tmp_path / "scores")
    ingest.append_parquet(scores(stream(spark, landed)), out, str(tmp_path / "cp"))
    assert rows(spark.read.parquet(out)) == rows(scores(corpus))
