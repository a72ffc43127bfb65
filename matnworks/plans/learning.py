"""Training, evaluation and scoring with MLlib models. Fitted models have no SQL form."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matnworks.fixed_values import MODEL_NAMES
from matnworks.functions import words
from matnworks.operators import cleaning, evaluation, models, reports, split
from matnworks.plans.corpus import CORPUS
from matnworks.plans.shared_sql import BUCKET, CLEAN
from matnworks.registry import query
from matnworks.sources import files
from matnworks.sources.tables import ar_documents, arabic_script, class_labels, documents, labelled


def prepared_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, clean_text`` and features of all documents."""
    return cleaning.prepare(ar_documents(spark, sf_dir)).drop("text")


def training_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared documents with labels.

    Texts are joined before cleaning, so unlabelled ones are not cleaned, and the filter on empty
    texts sees the stored column, so it is pushed to the scan.
    """
    raw = cleaning.clean_corpus(labelled(documents(spark, sf_dir), class_labels(spark, sf_dir)))
    corpus = raw.withColumn("text", arabic_script(F.col("text")))
    return cleaning.prepare(corpus).drop("text")


def _evaluated(spark: SparkSession, sf_dir: str, *kinds: str) -> DataFrame:
    table = models.training_table(training_corpus(spark, sf_dir))
    fitted = {MODEL_NAMES[kind]: model for kind, model in models.fit_models(table, *kinds).items()}
    return models.evaluate_models(fitted, split.take(table, "test"))


@query("train_lr")
def train_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _evaluated(spark, sf_dir, "lr")


@query("train_rf")
def train_rf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _evaluated(spark, sf_dir, "rf")


@query("train_svm")
def train_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _evaluated(spark, sf_dir, "svm")


@query("model_comparison")
def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per model, all fitted on the same vectors."""
    wanted = ("model", "accuracy", "precision", "recall", "f1", "auc", "TP", "TN", "FP", "FN", "human_f1", "ai_f1")
    return _evaluated(spark, sf_dir, "lr", "rf", "svm").select(*wanted).orderBy(F.desc("f1"), "model")


TEST_ROWS = f"""WITH {CORPUS}, test AS (SELECT * FROM corpus WHERE {BUCKET} >= 85)"""
ACTUAL = "count(*) AS test_rows, count(*) FILTER (label = 0) AS actual_human, count(*) FILTER (label = 1) AS actual_ai"


@query(
    "model_test_rows",
    f"""{TEST_ROWS} SELECT model, {ACTUAL} FROM test, (VALUES {", ".join(f"('{name}')" for name in MODEL_NAMES.values())}) AS m(model)
        GROUP BY model""",
)
def model_test_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each model's confusion counts say about the test split: rows, and rows of each class."""
    counts = model_comparison(spark, sf_dir)
    return counts.select(
        "model",
        F.expr("TP + TN + FP + FN").alias("test_rows"),
        F.expr("TN + FP").alias("actual_human"),
        F.expr("TP + FN").alias("actual_ai"),
    )


def candidates() -> dict[str, Estimator]:
    """A small grid around the fixed parameters of the linear models."""
    out = {}
    for kind, weights in (("lr", (0.001, 0.01, 0.1)), ("svm", (0.0005, 0.005, 0.05))):
        for weight in weights:
            one = models.classifier(kind)
            out[f"{MODEL_NAMES[kind]} regParam={weight}"] = one.copy({one.getParam("regParam"): weight})
    return out


def _selected(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, PipelineModel]:
    table = models.training_table(training_corpus(spark, sf_dir))
    return table, *models.select_model(table, candidates())


@query("model_selection")
def model_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candidates on the validation split, and which one is chosen."""
    return _selected(spark, sf_dir)[1]


VAL_ROWS = f"""WITH {CORPUS}, val AS (SELECT * FROM corpus WHERE {BUCKET} >= 70 AND {BUCKET} < 85)"""


@query(
    "model_selection_rows",
    f"""{VAL_ROWS} SELECT 6::BIGINT AS candidates, 1::BIGINT AS chosen, 0::BIGINT AS better, 6 * count(*) AS val_rows,
          6 * count(*) FILTER (label = 0) AS actual_human, 6 * count(*) FILTER (label = 1) AS actual_ai FROM val""",
)
def model_selection_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the selection says about the validation split, and whether a candidate beats the chosen one."""
    results = model_selection(spark, sf_dir)
    best, mine = F.max("f1"), F.max(F.when(F.col("chosen"), F.col("f1")))
    return results.agg(
        F.count("*").alias("candidates"),
        F.count_if("chosen").alias("chosen"),
        (best > mine).cast("bigint").alias("better"),
        F.sum(F.expr("TP + TN + FP + FN")).alias("val_rows"),
        F.sum(F.expr("TN + FP")).alias("actual_human"),
        F.sum(F.expr("TP + FN")).alias("actual_ai"),
    )


@query("selected_model")
def selected_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chosen model on the test split, which the selection did not see."""
    table, results, model = _selected(spark, sf_dir)
    name = results.where("chosen").first()["model"]
    return models.evaluate_models({name: model}, split.take(table, "test"))


@query("model_errors")
def model_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five misclassified documents of the test split, by the logistic model."""
    table, model = _fitted(spark, sf_dir, "lr")
    scored = models.predictions(model, split.take(table, "test")).select("doc_id", "label", "prediction")
    return models.model_errors(files.materialize(scored, "predictions"), ar_documents(spark, sf_dir))


@query("model_per_class")
def model_per_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision, recall and F1 by class of each model on the test split."""
    table = models.training_table(training_corpus(spark, sf_dir))
    fitted = {MODEL_NAMES[kind]: model for kind, model in models.fit_models(table, "lr", "rf", "svm").items()}
    scored = files.materialize(models.predictions_of_all(fitted, split.take(table, "test")), "predictions")
    rows = [
        evaluation.evaluate_per_class(scored.where(F.col("model") == name)).select(F.lit(name).alias("model"), "*")
        for name in fitted
    ]
    return reduce(DataFrame.unionByName, rows)


def _fitted(spark: SparkSession, sf_dir: str, kind: str) -> tuple[DataFrame, PipelineModel]:
    table = models.training_table(training_corpus(spark, sf_dir))
    return table, models.fit_models(table, kind)[kind]


@query("feature_importance")
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.feature_importance(*_fitted(spark, sf_dir, "rf"))


@query("feature_report")
def feature_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature means by label with the forest importance of each feature."""
    table, model = _fitted(spark, sf_dir, "rf")
    # Five rows.
    importance = F.broadcast(models.feature_importance(table, model))
    return reports.feature_summary(table).join(importance, "feature")


@query("lr_coefficients")
def lr_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.lr_coefficients(*_fitted(spark, sf_dir, "lr"))


@query("score_batch")
def score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, labelled or not, scored with the logistic model."""
    _, model = _fitted(spark, sf_dir, "lr")
    return model.transform(prepared_documents(spark, sf_dir)).select(
        "doc_id", "prediction", vector_to_array("probability")[1].alias("probability_ai")
    )


@query("model_roundtrip")
def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of the test split by a model that was saved and loaded again."""
    table, model = _fitted(spark, sf_dir, "lr")
    path = files.scratch(spark, "model")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    return models.predictions(loaded, split.take(table, "test"))


@query("model_roundtrip_check", f"{TEST_ROWS} SELECT count(*) AS test_rows, 0::BIGINT AS changed FROM test")
def model_roundtrip_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the test split, and those whose score or class changed by saving and loading."""
    table, model = _fitted(spark, sf_dir, "lr")
    path = files.scratch(spark, "model")
    model.write().overwrite().save(path)
    test = split.take(table, "test")
    again = models.predictions(PipelineModel.load(path), test).select(
        "doc_id", F.col("score").alias("score_again"), F.col("prediction").alias("prediction_again")
    )
    both = models.predictions(model, test).join(again, "doc_id")
    return both.agg(
        F.count("*").alias("test_rows"),
        F.count_if(F.expr("score <> score_again OR prediction <> prediction_again")).alias("changed"),
    )


@query(
    "score_batch_check",
    "SELECT count(*) AS scored, count(DISTINCT doc_id) AS documents, 0::BIGINT AS out_of_range FROM documents",
)
def score_batch_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored rows, scored documents, and probabilities that are none."""
    return score_batch(spark, sf_dir).agg(
        F.count("*").alias("scored"),
        F.count_distinct("doc_id").alias("documents"),
        F.count_if(F.expr("probability_ai IS NULL OR NOT probability_ai BETWEEN 0 AND 1")).alias("out_of_range"),
    )


@query("tfidf_hashed")
def tfidf_hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashed TF-IDF vectors."""
    docs = files.materialize(cleaning.with_clean_text(ar_documents(spark, sf_dir)).drop("text"), "clean")
    tokenizer, hashing, idf = models.tfidf_stages()
    hashed = hashing.transform(tokenizer.transform(docs))
    weighted = idf.fit(hashed).transform(hashed)
    return weighted.select("doc_id", F.size("tokens").alias("n_tokens"), "tfidf")


@query(
    "tfidf_hashed_mass",
    f"""WITH {CLEAN} SELECT doc_id, greatest(len(stems), 1) AS n_tokens, greatest(len(stems), 1)::DOUBLE AS mass FROM clean""",
)
def tfidf_hashed_mass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each document and the sum of its hashed term frequencies. MLlib takes an empty text as one empty token."""
    docs = cleaning.with_clean_text(ar_documents(spark, sf_dir)).drop("text")
    tokenizer, hashing, _ = models.tfidf_stages()
    hashed = hashing.transform(tokenizer.transform(docs))
    mass = F.aggregate(vector_to_array("raw_tf"), F.lit(0.0), lambda a, b: a + b)
    return hashed.select("doc_id", F.size("tokens").cast("bigint").alias("n_tokens"), mass.alias("mass"))


@query("word2vec")
def word2vec(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = words.clean_text(F.col("text")).alias("clean_text")
    vectors = models.word2vec(ar_documents(spark, sf_dir).select("doc_id", clean))
    return vectors.select("doc_id", vector_to_array("vector").alias("vector"))
