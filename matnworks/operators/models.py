"""TF-IDF vectors, classifiers and their evaluation with MLlib.

One pipeline is fitted on the training rows and serves batches and streams alike.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import IDF, HashingTF, SQLTransformer, Tokenizer, VectorAssembler, Word2Vec
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matnworks.fixed_values import (
    FEATURES,
    FOREST_PARAMS,
    LOGISTIC_PARAMS,
    MIN_DOC_FREQ,
    SVM_PARAMS,
    TFIDF_DIMENSIONS,
    WORD2VEC_DIMENSIONS,
)
from matnworks.operators.evaluation import best_model, evaluation_table, roc_auc
from matnworks.operators.profile import with_class_weight
from matnworks.operators.split import take
from matnworks.sources.files import materialize


def tfidf_stages(dimensions: int = TFIDF_DIMENSIONS, min_doc_freq: int = MIN_DOC_FREQ) -> list:
    return [
        Tokenizer(inputCol="clean_text", outputCol="tokens"),
        HashingTF(inputCol="tokens", outputCol="raw_tf", numFeatures=dimensions),
        IDF(inputCol="raw_tf", outputCol="tfidf", minDocFreq=min_doc_freq),
    ]


def vector_pipeline() -> Pipeline:
    """Clean text and features to one vector: the TF-IDF slots, then the five features.

    Rows with a missing feature are skipped before the TF-IDF stages. If the assembler skipped them, its
    filter would hold the TF-IDF column and compute it a second time.
    """
    present = " AND ".join(f"{name} IS NOT NULL" for name in FEATURES)
    skip = SQLTransformer(statement=f"SELECT * FROM __THIS__ WHERE {present}")
    assembler = VectorAssembler(inputCols=["tfidf", *FEATURES], outputCol="features", handleInvalid="error")
    return Pipeline(stages=[skip, *tfidf_stages(), assembler])


def classifier(kind: str, weighted_svm: bool = False):
    """``lr`` and ``rf`` use class weights; ``svm`` does on request."""
    if kind == "lr":
        return LogisticRegression(weightCol="classWeight", **LOGISTIC_PARAMS)
    if kind == "rf":
        return RandomForestClassifier(weightCol="classWeight", **FOREST_PARAMS)
    if kind == "svm":
        return LinearSVC(**SVM_PARAMS, **({"weightCol": "classWeight"} if weighted_svm else {}))
    raise ValueError(f"unknown model: {kind}")


def training_table(corpus: DataFrame) -> DataFrame:
    """``doc_id, label, clean_text`` and the features, written once for the passes of training."""
    columns = ["doc_id", F.col("label").cast("double").alias("label"), "clean_text", *FEATURES]
    return materialize(corpus.select(*columns), "training")


def dealt(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows in ``partitions`` (by default the session's shuffle partitions) by ``doc_id``, and sorted there.

    A forest depends on the layout of its rows: with this, the same rows in other files give the same model.
    """
    number = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(number, "doc_id").sortWithinPartitions("doc_id")


def fit_candidates(
    table: DataFrame, candidates: dict[str, Estimator], partitions: int | None = None
) -> dict[str, PipelineModel]:
    """Fit vectors and then each classifier on the training split. Nothing of the other splits is seen.

    All candidates share the vectors, which are computed once and kept (on disk where memory is short) for the
    passes of the classifiers. Class weights are counted on the stored label, so no vector is computed for them.
    """
    train = take(table, "train")
    vectors = vector_pipeline().fit(train)
    vectorized = vectors.transform(with_class_weight(train)).select("doc_id", "label", "classWeight", "features")
    prepared = dealt(vectorized, partitions).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return {name: PipelineModel([*vectors.stages, c.fit(prepared)]) for name, c in candidates.items()}
    finally:
        prepared.unpersist()


def fit_models(
    table: DataFrame, *kinds: str, partitions: int | None = None, weighted_svm: bool = False
) -> dict[str, PipelineModel]:
    """The classifiers ``kinds`` with their fixed parameters."""
    return fit_candidates(table, {kind: classifier(kind, weighted_svm) for kind in kinds}, partitions)


def predictions(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``doc_id, label, prediction, score``; the score is the raw value of class 1."""
    return model.transform(df).select(
        "doc_id", "label", "prediction", vector_to_array("rawPrediction")[1].alias("score")
    )


def model_errors(scored: DataFrame, texts: DataFrame, rows: int = 5, chars: int = 300) -> DataFrame:
    """The first misclassified rows by ``doc_id`` of a frame of predictions, with their text cut for display."""
    wrong = scored.where("label <> prediction").orderBy("doc_id").limit(rows)
    joined = texts.select("doc_id", F.substring("text", 1, chars).alias("text")).join(F.broadcast(wrong), "doc_id")
    return joined.select("doc_id", "text", F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"))


def evaluate_model(model: PipelineModel, df: DataFrame, name: str) -> DataFrame:
    """One row: model, weighted metrics, AUC, confusion counts and F1 by class.

    The model runs once; its narrow predictions are written and read by both metric jobs.
    """
    scored = materialize(predictions(model, df), "predictions")
    auc = roc_auc(scored, "score").scalar()
    return evaluation_table(scored).select(F.lit(name).alias("model"), "*", auc.alias("auc"))


def _own_columns(model: Model, number: int) -> Model:
    """A copy whose outputs have names of their own, so that several models can score one frame."""
    own = model.copy()
    for name in ("prediction", "rawPrediction", "probability"):
        if own.hasParam(f"{name}Col"):
            own.set(own.getParam(f"{name}Col"), f"{name}_{number}")
    return own


def predictions_of_all(fitted: dict[str, PipelineModel], df: DataFrame) -> DataFrame:
    """``model, doc_id, label, prediction, score`` of models with shared vectors, which are computed once."""
    first, *others = fitted.values()
    if any(m.stages[:-1] != first.stages[:-1] for m in others):
        raise ValueError("the models were not fitted on the same vectors")
    out = PipelineModel(first.stages[:-1]).transform(df).select("doc_id", "label", "features")
    rows = []
    for number, (name, model) in enumerate(fitted.items()):
        out = _own_columns(model.stages[-1], number).transform(out)
        score = vector_to_array(f"rawPrediction_{number}")[1].alias("score")
        rows.append(F.struct(F.lit(name).alias("model"), F.col(f"prediction_{number}").alias("prediction"), score))
    return out.select("doc_id", "label", F.explode(F.array(*rows)).alias("m")).select(
        "m.model", "doc_id", "label", "m.prediction", "m.score"
    )


def evaluate_models(fitted: dict[str, PipelineModel], df: DataFrame) -> DataFrame:
    """The row of ``evaluate_model`` for each model; all score the rows in one pass."""
    scored = materialize(predictions_of_all(fitted, df), "predictions")
    aucs = [
        roc_auc(scored.where(F.col("model") == name), "score").select(F.lit(name).alias("model"), "auc") for name in fitted
    ]
    auc = aucs[0]
    for one in aucs[1:]:
        auc = auc.unionByName(one)
    # As many rows as there are models.
    return evaluation_table(scored, "model").join(F.broadcast(auc), "model")


def select_model(
    table: DataFrame, candidates: dict[str, Estimator], partitions: int | None = None
) -> tuple[DataFrame, PipelineModel]:
    """Metrics of every candidate on the validation split, with ``chosen``, and the chosen model.

    The candidates are fitted on the training split; the highest F1 wins, ties go to the first name. The test
    split is not looked at, so it still measures the chosen model.
    """
    fitted = fit_candidates(table, candidates, partitions)
    results = materialize(evaluate_models(fitted, take(table, "val")), "selection")
    best = best_model(results).first()["model"] if not results.isEmpty() else min(fitted)
    return results.withColumn("chosen", F.col("model") == best), fitted[best]


def feature_slots(model: PipelineModel, df: DataFrame) -> dict[str, int]:
    """Slot of each named input in the vector, as the assembler states it in the attributes of its column."""
    schema = PipelineModel(model.stages[:-1]).transform(df.limit(0)).schema
    attributes = schema["features"].metadata["ml_attr"]["attrs"]
    return {a["name"]: a["idx"] for kind in attributes.values() for a in kind if "name" in a}


def _rows(df: DataFrame, model: PipelineModel, values, schema: str) -> DataFrame:
    slots = feature_slots(model, df)
    return df.sparkSession.createDataFrame([(name, float(values[slots[name]])) for name in FEATURES], schema)


def feature_importance(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Forest importance of the five features; ``df`` has the columns that the model reads."""
    return _rows(df, model, model.stages[-1].featureImportances, "feature string, importance double")


def lr_coefficients(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Coefficients of the five features by absolute value; ``df`` has the columns that the model reads."""
    rows = _rows(df, model, model.stages[-1].coefficients, "feature string, cofficient double")
    return rows.withColumn("abs_coef", F.abs("cofficient")).orderBy(F.desc("abs_coef"))


def word2vec(df: DataFrame, min_count: int = 5, slots: int = 1 << 16, partitions: int | None = None) -> DataFrame:
    """``doc_id, vector``: mean word vector of each document.

    MLlib keeps the vocabulary on the driver, so words are hashed to ``slots`` numbers, as TF-IDF hashes
    them; the model has the same size and the same rules whatever the corpus. It is fitted in ``partitions`` parts,
    by default the session's shuffle partitions, and their vectors are averaged.
    """
    slot = lambda w: F.pmod(F.xxhash64(w), F.lit(slots)).cast("string")
    hashed = F.transform(F.filter(F.split("clean_text", " "), lambda w: w != ""), slot)
    corpus = materialize(df.select("doc_id", hashed.alias("tokens")), "tokens")
    model = Word2Vec(
        vectorSize=WORD2VEC_DIMENSIONS,
        minCount=min_count,
        numPartitions=partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")),
        seed=42,
        inputCol="tokens",
        outputCol="vector",
    ).fit(corpus)
    return model.transform(corpus).select("doc_id", "vector")
