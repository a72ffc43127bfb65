import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from matnworks.operators import evaluation


def predictions(n=500, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        label = float(rng.random() < 0.8)
        # Rounded, so that scores tie. MLlib takes -0.0 and 0.0 for two scores; there is only one here.
        score = round(rng.gauss(label, 1.0), 1) + 0.0
        rows.append((i, label, float(score > 0.4), score))
    return rows


SCHEMA = "doc_id long, label double, prediction double, score double"


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame(predictions(), SCHEMA).cache()


@pytest.mark.parametrize(
    "ours,theirs",
    [("accuracy", "accuracy"), ("precision", "weightedPrecision"), ("recall", "weightedRecall"), ("f1", "f1")],
)
def test_weighted_metrics_equal_mllib(scored, ours, theirs):
    expected = MulticlassClassificationEvaluator(metricName=theirs).evaluate(scored)
    assert evaluation.evaluate(scored).first()[ours] == pytest.approx(expected, abs=1e-12)


@pytest.mark.parametrize("label", [0, 1])
@pytest.mark.parametrize(
    "ours,theirs", [("precision", "precisionByLabel"), ("recall", "recallByLabel"), ("f1", "fMeasureByLabel")]
)
def test_per_class_metrics_equal_mllib(scored, label, ours, theirs):
    expected = MulticlassClassificationEvaluator(metricName=theirs, metricLabel=float(label)).evaluate(scored)
    row = evaluation.evaluate_per_class(scored).filter(F.col("label") == label).first()
    assert row[ours] == pytest.approx(expected, abs=1e-12)


@pytest.mark.parametrize("partitions", [2, 7, 300])
def test_auc_equals_mllib(spark, scored, partitions, shuffle_partitions):
    shuffle_partitions(partitions)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    auc = evaluation.roc_auc(scored, "score").first().auc
    assert auc == pytest.approx(evaluator.evaluate(scored), abs=1e-12)


@pytest.mark.parametrize("partitions", [2, 300])
def test_auc_equals_pair_counting(spark, partitions, shuffle_partitions):
    """Brute force over all pairs; negative zero is the same score as zero."""
    shuffle_partitions(partitions)
    rows = predictions(200, seed=5) + [(i, float(i % 2), 1.0, 0.0 if i % 3 else -0.0) for i in range(200, 230)]
    pos, neg = ([r[3] for r in rows if r[1] == label] for label in (1.0, 0.0))
    wins = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
    auc = evaluation.roc_auc(spark.createDataFrame(rows, SCHEMA), "score").first().auc
    assert auc == pytest.approx(wins / (len(pos) * len(neg)), abs=1e-12)


def test_auc_with_one_score_for_most_rows(spark):
    rows = [(i, float(i % 2), 0.0, 0.5 if i % 3 else float(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    expected = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(df)
    assert evaluation.roc_auc(df, "score").first().auc == pytest.approx(expected, abs=1e-12)


def test_auc_is_zero_without_a_class_or_rows(spark):
    one_class = spark.createDataFrame([(1, 1.0, 1.0, 0.3), (2, 1.0, 0.0, 0.1)], SCHEMA)
    assert evaluation.roc_auc(one_class, "score").first().auc == 0.0
    assert evaluation.roc_auc(one_class.limit(0), "score").first().auc == 0.0


def test_null_labels_and_scores_are_left_out_and_counted(spark):
    rows = [(1, 1.0, 1.0, 0.9), (2, 0.0, 0.0, 0.1), (3, None, 1.0, 0.5), (4, 1.0, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    counts = evaluation.confusion_matrix(df).first()
    assert (counts.TP, counts.TN, counts.FP, counts.FN, counts.n_unlabelled) == (1, 1, 0, 0, 2)
    assert evaluation.evaluate(df).first().accuracy == 1.0
    assert evaluation.roc_auc(df, "score").first().auc == 1.0


def test_undefined_metrics_are_zero(spark):
    df = spark.createDataFrame([(1, 0.0, 1.0, 0.2)], SCHEMA)
    assert [tuple(r) for r in evaluation.evaluate_per_class(df).orderBy("label").collect()] == [
        (0, 0.0, 0.0, 0.0),
        (1, 0.0, 0.0, 0.0),
    ]
    assert tuple(evaluation.evaluate(df.limit(0)).first()) == (0, 0.0, 0.0, 0.0, 0.0)


def test_groups_are_evaluated_alone(scored):
    grouped = scored.withColumn("g", (F.col("doc_id") % 3).cast("int"))
    by_group = {r.g: r.f1 for r in evaluation.evaluate(grouped, "g").collect()}
    for g, f1 in by_group.items():
        assert f1 == evaluation.evaluate(grouped.filter(F.col("g") == g)).first().f1


def test_best_model_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("b", 0.9), ("a", 0.9), ("c", 0.1)], "model string, f1 double")
    assert evaluation.best_model(df).first().model == "a"
