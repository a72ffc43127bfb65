from pathlib import Path

import pytest
from pyspark.sql import types as T

from matnworks.sources import files
from matnworks.sources.tables import DOCUMENTS, spread, table
from matnworks.streaming import ingest

ROWS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
TRICKY = [
    (1, 'a "quoted" word'),
    (2, "two\nlines"),
    (3, " leading and trailing "),
    (4, "comma, semicolon; tab\t"),
    (5, ""),
    (6, None),
    (7, 'ends with \\'),
    (8, '"'),
    (9, "كتاب،\r\n«جديد»"),
    (10, "# not a comment"),
]


# An empty field is a missing one in CSV.
READ_BACK = [(i, t or None) for i, t in TRICKY]


def test_csv_keeps_every_text(spark, tmp_path):
    df = spark.createDataFrame(TRICKY, ROWS)
    files.write_csv(df, str(tmp_path / "csv"))
    assert sorted(map(tuple, files.read_csv(spark, str(tmp_path / "csv"), ROWS).collect())) == READ_BACK


def test_csv_files_are_bounded(spark, tmp_path):
    files.write_csv(spark.range(1000).coalesce(1), str(tmp_path / "csv"), rows_per_file=100)
    assert len(list((tmp_path / "csv").glob("*.csv"))) == 10


def test_csv_with_byte_order_mark(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "batch.csv").write_bytes('doc_id,text\n1,"كتاب\nجديد"\n'.encode("utf-8-sig"))
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path / "in"), ROWS).collect()] == [(1, "كتاب\nجديد")]


def test_csv_stream_reads_the_same_dialect(spark, tmp_path):
    files.write_csv(spark.createDataFrame(TRICKY, ROWS).repartition(3), str(tmp_path / "in"))
    stream = ingest.csv_stream(spark, str(tmp_path / "in"), ROWS, files_per_trigger=1)
    ingest.append_parquet(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == READ_BACK


def test_contract_names_what_is_wrong(spark):
    df = spark.createDataFrame([(1, 2)], "doc_id long, text long")
    with pytest.raises(ValueError, match="text should be string, is bigint"):
        files.require_columns(df, ROWS)
    with pytest.raises(ValueError, match="text should be string, is missing"):
        files.require_columns(df.drop("text"), ROWS)
    assert files.require_columns(spark.createDataFrame(TRICKY, ROWS), ROWS).count() == len(TRICKY)


def test_verify_written(spark, tmp_path):
    df = spark.range(10)
    files.write_parquet(df, str(tmp_path / "t"))
    assert files.verify_written(df, spark.read.parquet(str(tmp_path / "t"))) == 10
    with pytest.raises(ValueError, match="row count"):
        files.verify_written(df, df.limit(9))
    with pytest.raises(ValueError, match="schema"):
        files.verify_written(df, df.withColumnRenamed("id", "other"))


def test_writes_replace_earlier_output(spark, tmp_path):
    for write, read in ((files.write_parquet, spark.read.parquet), (files.write_orc, spark.read.orc)):
        path = str(tmp_path / write.__name__)
        write(spark.range(5), path)
        write(spark.range(3), path)
        assert read(path).count() == 3


def test_scratch_uses_the_shared_folder(spark):
    assert files.scratch(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert files.scratch(spark, "x") != files.scratch(spark, "x")


def test_scratch_tables_are_removed(spark):
    base = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(base.iterdir())
    kept = files.materialize(spark.range(3).toDF("x"), "kept")
    with files.scratch_space(spark):
        inner = files.materialize(spark.range(5).toDF("x"), "inner")
        assert inner.count() == 5
    assert len(set(base.iterdir()) - before) == 1
    assert kept.count() == 3
    assert files.release(spark) >= 1
    assert not set(base.iterdir()) - before


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master, applicationId = "spark://host:7077", "app"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        files.scratch(Session(), "x")


def test_spread_leaves_wide_scans_alone(spark, sf_dir):
    wide = spark.range(100, numPartitions=64)
    assert spread(wide, "id") is wide
    narrow = table(spark, sf_dir, "documents")
    assert spread(narrow, "doc_id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_documents_follow_the_contract(spark, sf_dir):
    files.require_columns(table(spark, sf_dir, "documents"), DOCUMENTS)
