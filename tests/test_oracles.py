"""Every query that SQL can express gives exactly the oracle's rows."""

import pytest
from compare import connect, duckdb_result, spark_result

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, sf_dir, con, name):
    columns, rows = spark_result(QUERIES[name](spark, sf_dir))
    expected_columns, expected = duckdb_result(con, ORACLES[name])
    assert columns == expected_columns
    assert rows == expected


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_is_the_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["label", "avg_f3", "avg_f24", "avg_f45", "avg_f66", "avg_f87"]
    assert df.count() == 2


ROW_LOCAL = sorted(name for name in ORACLES if not name.startswith(("stream_", "model_", "score_batch", "op", "pipeline")))


@pytest.mark.parametrize("name", ROW_LOCAL)
def test_result_does_not_depend_on_partitioning(spark, sf_dir, name, monkeypatch):
    from matnworks.plans import corpus
    from matnworks.sources import tables

    baseline = spark_result(QUERIES[name](spark, sf_dir))
    original = tables.spread
    for module in (tables, corpus):
        monkeypatch.setattr(module, "spread", lambda df, key: original(df, key).repartition(3))
    assert spark_result(QUERIES[name](spark, sf_dir)) == baseline
