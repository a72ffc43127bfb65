"""From CSV files of text and label to reports, models and a scored stream, on real file boundaries."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from matnworks.fixed_values import FEATURES
from matnworks.operators import cleaning, models, profile, reports, split, vocabulary
from matnworks.sources import files
from matnworks.sources.tables import ar_documents, class_labels, labelled
from matnworks.streaming import ingest, scoring

RAW = T.StructType([T.StructField("text", T.StringType()), T.StructField("label", T.StringType())])


def test_whole_flow(spark, sf_dir, tmp_path):
    at = lambda name: str(tmp_path / name)
    source = labelled(ar_documents(spark, sf_dir), class_labels(spark, sf_dir))
    files.write_csv(source.select("text", "label"), at("raw"))

    raw = files.require_columns(files.read_csv(spark, at("raw"), RAW), RAW)
    corpus = cleaning.clean_corpus(cleaning.with_doc_id(raw))
    assert corpus.count() == source.count()
    assert profile.label_distribution(corpus).agg(F.sum("n")).first()[0] == source.count()

    processed = cleaning.processed_corpus(corpus)
    files.write_parquet(processed, at("processed.parquet"))
    files.write_orc(processed, at("processed.orc"))
    stored = spark.read.parquet(at("processed.parquet"))
    assert files.verify_written(processed, stored) == spark.read.orc(at("processed.orc")).count()

    top = vocabulary.top(vocabulary.word_count(stored), "word", 20)
    assert top.count() == 20

    features = cleaning.with_features(stored)
    summary = reports.feature_summary(features)
    files.write_csv(summary, at("summary"))
    assert files.read_csv(spark, at("summary"), summary.schema).count() == len(FEATURES)

    table = models.training_table(features)
    model = models.fit_models(table, "lr", partitions=4)["lr"]
    test = split.take(table, "test")
    evaluation = models.evaluate_model(model, test, "LR").first()
    assert evaluation.TP + evaluation.TN + evaluation.FP + evaluation.FN == test.count()

    arriving = features.select("doc_id", "text", "label", *FEATURES)
    files.write_csv(arriving.repartition(4, "doc_id"), at("incoming"))
    stream = ingest.csv_stream(spark, at("incoming"), arriving.schema, files_per_trigger=1)

    def score(batch):
        predicted = model.transform(cleaning.with_clean_text(batch))
        return predicted.select("doc_id", "text", "label", F.col("prediction").cast("int"))

    scoring.score_stream(stream, score, at("results"))
    scored = scoring.scored_rows(spark, at("results"))
    batch = model.transform(table).select("doc_id", F.col("prediction").cast("int"))
    compare = lambda df: sorted(map(tuple, df.select("doc_id", "prediction").collect()))
    assert compare(scored) == compare(batch)
    assert scoring.batch_metrics(spark, at("results")).agg(F.sum("n_records")).first()[0] == source.count()
