"""Properties of the physical plans that matter at scale."""

import pytest

import __spark_entry__ as entry

QUERIES = entry.queries()
LAZY = sorted(
    {name for name in entry.oracle_sql() if not name.startswith(("op", "pipeline", "model_", "score_batch"))}
    - {"stream_latency_check", "stream_scores_check", "tfidf_terms", "eval_auc", "stream_ingest", "stream_features", "stream_linear_scores",
       "stream_batch_metrics", "stream_summary", "csv_roundtrip", "parquet_roundtrip", "orc_roundtrip"}
)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for operator in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoop"):
        assert operator not in text


@pytest.mark.parametrize("name", ["label_distribution", "class_imbalance", "class_weights", "length_by_label"])
def test_filters_reach_the_scan_and_text_stays_there(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "IsNotNull(text), Not(EqualTo(text,))" in text
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text
    joined = text[: text.index("FileScan")]
    assert "text#" not in joined[joined.index("Join") :].split("\n")[0]


@pytest.mark.parametrize("name", ["feature_means_by_label", "score_linear", "error_sample", "confusion_matrix"])
def test_text_is_transliterated_once(spark, sf_dir, name):
    assert plan(QUERIES[name](spark, sf_dir)).count("translate(") == 1


def test_top_k_keeps_k_rows_per_task(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_words"](spark, sf_dir))


def test_split_counts_read_one_column(spark, sf_dir):
    assert "ReadSchema: struct<doc_id:bigint>" in plan(QUERIES["split_counts"](spark, sf_dir))
