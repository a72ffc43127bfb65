import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from matnworks.fixed_values import FEATURES, TFIDF_DIMENSIONS
from matnworks.operators import cleaning, evaluation, models, profile, split
from matnworks.plans import learning
from matnworks.plans.learning import prepared_documents, training_corpus

FEATURES_LIST = list(FEATURES)


@pytest.fixture(scope="module")
def table(spark, sf_dir):
    return models.training_table(training_corpus(spark, sf_dir))


@pytest.fixture(scope="module")
def fitted(table):
    return models.fit_models(table, "lr", "rf", "svm")


def test_vector_layout(table, fitted):
    out = fitted["lr"].transform(split.take(table, "test"))
    row = out.first()
    assert row.features.size == TFIDF_DIMENSIONS + len(FEATURES)
    for i, name in enumerate(FEATURES):
        assert row.features[TFIDF_DIMENSIONS + i] == row[name]


def test_parameters(fitted):
    lr, rf, svm = (fitted[k].stages[-1] for k in ("lr", "rf", "svm"))
    assert (lr.getMaxIter(), lr.getRegParam(), lr.getWeightCol()) == (20, 0.01, "classWeight")
    assert (rf.getNumTrees, rf.getMaxDepth(), rf.getWeightCol()) == (50, 10, "classWeight")
    assert (svm.getMaxIter(), svm.getRegParam()) == (20, 0.005)
    assert not svm.isDefined("weightCol")
    assert models.classifier("svm", weighted_svm=True).getWeightCol() == "classWeight"
    with pytest.raises(ValueError, match="unknown model"):
        models.classifier("tree")


def test_idf_sees_training_rows_only(table, fitted):
    """Document frequencies are those of the training split, below-threshold ones set to 0."""
    train = split.take(table, "train")
    idf = fitted["lr"].stages[3]
    assert idf.numDocs == train.count()
    hashed = PipelineModel(fitted["lr"].stages[:3]).transform(train)
    expected = [0] * TFIDF_DIMENSIONS
    for row in hashed.select("raw_tf").collect():
        for slot in row.raw_tf.indices:
            expected[slot] += 1
    assert list(idf.docFreq) == [n if n >= 3 else 0 for n in expected]


def test_evaluation_counts_the_test_split(table, fitted):
    test = split.take(table, "test")
    for name, model in fitted.items():
        row = models.evaluate_model(model, test, name).first()
        assert row.TP + row.TN + row.FP + row.FN == test.count()
        assert row.model == name
        assert 0 <= row.auc <= 1
        again = evaluation.evaluate(model.transform(test)).first()
        assert row.f1 == pytest.approx(again.f1, abs=1e-12)


def test_saved_model_gives_the_same_scores(table, fitted, tmp_path):
    test = split.take(table, "test")
    path = str(tmp_path / "model")
    for _ in range(2):  # a second save replaces the first
        fitted["lr"].write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(models.predictions(loaded, test)) == key(models.predictions(fitted["lr"], test))


def test_feature_reports(table, fitted):
    importance = models.feature_importance(table, fitted["rf"]).collect()
    assert [r.feature for r in importance] == list(FEATURES)
    assert all(0 <= r.importance <= 1 for r in importance)
    coefficients = models.lr_coefficients(table, fitted["lr"]).collect()
    assert {r.feature for r in coefficients} == set(FEATURES)
    assert [r.abs_coef for r in coefficients] == sorted((abs(r.cofficient) for r in coefficients), reverse=True)


def test_rows_with_missing_features_are_skipped(table, fitted):
    test = split.take(table, "test")
    broken = test.withColumn("f87_gini", F.when(F.col("doc_id") % 2 == 0, F.col("f87_gini")))
    expected = test.filter(F.col("doc_id") % 2 == 0).count()
    assert models.predictions(fitted["lr"], broken).count() == expected


def test_forest_does_not_depend_on_the_file_layout(spark, table, tmp_path):
    results = []
    for files in (1, 7):
        path = str(tmp_path / f"layout{files}")
        table.repartition(files, "label", "clean_text").write.parquet(path)
        forest = models.fit_models(spark.read.parquet(path), "rf")["rf"]
        results.append([r.importance for r in models.feature_importance(table, forest).collect()])
    assert results[0] == results[1]


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_vectors_are_computed_once_per_row(spark, sf_dir, table, fitted):
    scored = fitted["lr"].transform(prepared_documents(spark, sf_dir)).select("doc_id", "prediction", "probability")
    assert _plan(scored).count("UDF(UDF(UDF(") == 1
    assert _plan(fitted["lr"].transform(table).select("prediction")).count("UDF(UDF(UDF(clean_text") == 1
    assert "UDF" not in _plan(profile.with_class_weight(split.take(table, "train")).groupBy("label").count())


def test_model_errors_are_the_first_wrong_rows(spark):
    scored = spark.createDataFrame([(i, float(i % 2), 1.0) for i in range(20)], "doc_id long, label double, prediction double")
    texts = spark.createDataFrame([(i, "x" * 400) for i in range(20)], "doc_id long, text string")
    out = models.model_errors(scored, texts).orderBy("doc_id").collect()
    assert [r.doc_id for r in out] == [0, 2, 4, 6, 8]
    assert all(len(r.text) == 300 and r.label == 0 and r.prediction == 1 for r in out)


def test_word2vec_gives_one_vector_per_document(spark):
    texts = [(i, "كتاب بيت درس علم نظر " * 3) for i in range(20)]
    out = models.word2vec(spark.createDataFrame(texts, "doc_id long, clean_text string"))
    assert out.count() == 20
    assert out.first().vector.size == 50


def test_clean_text_is_derived_only_if_absent(spark):
    df = spark.createDataFrame([("الكتاب", "mine")], "text string, clean_text string")
    assert cleaning.with_clean_text(df).first().clean_text == "mine"
    assert cleaning.with_clean_text(df.drop("clean_text")).first().clean_text == "كتاب"


def test_all_models_are_scored_in_one_pass_as_each_by_itself(table, fitted):
    test = split.take(table, "test")
    together = models.predictions_of_all(fitted, test)
    assert _plan(together).count("UDF(UDF(UDF(clean_text") == 1
    found = {name: [] for name in fitted}
    for r in together.collect():
        found[r.model].append(tuple(r)[1:])
    for name, model in fitted.items():
        assert sorted(found[name]) == sorted(map(tuple, models.predictions(model, test).collect()))
    rows = {r.model: r for r in models.evaluate_models(fitted, test).collect()}
    for name, model in fitted.items():
        one = models.evaluate_model(model, test, name).first()
        assert all(rows[name][c] == pytest.approx(one[c], abs=1e-12) for c in one.asDict() if c != "model")
    other = models.fit_models(table, "svm")["svm"]
    with pytest.raises(ValueError, match="same vectors"):
        models.predictions_of_all({"a": fitted["lr"], "b": other}, test)


def test_selection_on_the_validation_rows(table):
    candidates = {k: v for k, v in learning.candidates().items() if k.startswith("Logistic") or "lr" in k.lower()}
    assert len(candidates) == 3
    results, best = models.select_model(table, candidates)
    rows = {r.model: r for r in results.collect()}
    assert rows.keys() == candidates.keys() and sum(r.chosen for r in rows.values()) == 1
    chosen = next(r for r in rows.values() if r.chosen)
    assert chosen.model == min(rows, key=lambda name: (-rows[name].f1, name))
    val = split.take(table, "val")
    direct = evaluation.evaluation_table(models.predictions(best, val)).first()
    assert all(chosen[c] == pytest.approx(direct[c], abs=1e-12) for c in direct.asDict())
    assert chosen.TP + chosen.TN + chosen.FP + chosen.FN == val.count()
    assert f"regParam={best.stages[-1].getRegParam()}" in chosen.model


def test_names_come_from_the_assembler(table, fitted):
    stages = [s.copy() for s in fitted["lr"].stages]
    assembler = stages[-2]
    assert models.feature_slots(fitted["lr"], table)[FEATURES_LIST[0]] == TFIDF_DIMENSIONS
    assembler.setInputCols([*FEATURES_LIST[::-1], "tfidf"])
    turned = PipelineModel(stages)
    slots = models.feature_slots(turned, table)
    assert [slots[name] for name in FEATURES_LIST] == [4, 3, 2, 1, 0]
    out = {r.feature: r.cofficient for r in models.lr_coefficients(table, turned).collect()}
    weights = stages[-1].coefficients
    assert out == {name: float(weights[4 - i]) for i, name in enumerate(FEATURES_LIST)}


def test_training_uses_the_partitions_of_the_session(spark, table, shuffle_partitions):
    shuffle_partitions(5)
    assert models.dealt(table).rdd.getNumPartitions() == 5
    assert models.dealt(table, 3).rdd.getNumPartitions() == 3
