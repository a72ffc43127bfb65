"""Mergeable sketches of vocabularies, and malformed records in batch and stream."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matnworks.functions.tokens import raw_tokens
from matnworks.operators import vocabulary
from matnworks.sources import files
from matnworks.sources.tables import documents
from matnworks.streaming import ingest, progress

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("label", T.IntegerType())])
LINES = [
    "id,text,label",
    "1,good,0",
    "2,,1",
    "3,no label,",
    "x4,bad id,1",
    "5,bad label,one",
    "6,short",
    '7,"quoted, with ""marks""",1',
    "8,too,1,long",
    "",
    "99999999999999999999,overflow,0",
    '9,"two\nlines",1',
]
GOOD = [(1, "good", 0), (2, None, 1), (3, "no label", None), (7, 'quoted, with "marks"', 1), (9, "two\nlines", 1)]
BAD = [
    ("5,bad label,one", "label"), ("6,short", "record"), ("8,too,1,long", "record"),
    ("99999999999999999999,overflow,0", "id"), ("x4,bad id,1", "id"),
]


@pytest.fixture()
def delivered(tmp_path):
    path = tmp_path / "in"
    path.mkdir()
    (path / "a.csv").write_text("\n".join(LINES) + "\n")
    (path / "b.csv").write_text("id,text,label\n10,more,0\n11,bad,zero\n")
    return str(path)


def test_every_row_is_in_one_of_both_tables(spark, delivered):
    raw = files.read_raw_csv(spark, delivered, SCHEMA)
    good, bad = files.well_formed(raw, SCHEMA), files.malformed(raw, SCHEMA)
    assert good.schema == SCHEMA
    assert sorted(map(tuple, good.collect())) == [*GOOD, (10, "more", 0)]
    assert sorted(map(tuple, bad.collect())) == sorted([*BAD, ("11,bad,zero", "label")])
    assert (good.count(), bad.count()) == (6, 6)
    assert good.select("id").count() == 6  # asking for some columns hides no fault


def test_quarantine_of_a_stream_and_restart_between_the_sinks(spark, delivered, tmp_path, monkeypatch):
    folder, real, calls = str(tmp_path / "out"), files.malformed, []

    def fails_once(*args):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("lost between the sinks")
        return real(*args)

    monkeypatch.setattr(files, "malformed", fails_once)
    with pytest.raises(Exception, match="lost between"):
        ingest.quarantine_stream(spark, delivered, SCHEMA, folder, files_per_trigger=1)
    ingest.quarantine_stream(spark, delivered, SCHEMA, folder, files_per_trigger=1)
    good = spark.read.parquet(f"{folder}/good").select("id", "text", "label")
    assert sorted(map(tuple, good.collect())) == [*GOOD, (10, "more", 0)]
    bad = spark.read.parquet(f"{folder}/bad").select("record", "reason")
    assert sorted(map(tuple, bad.collect())) == sorted([*BAD, ("11,bad,zero", "label")])
    assert progress.batch_times(spark, folder).count() == 2


def test_merged_sketches_equal_the_sketch_of_the_whole(spark, sf_dir):
    docs, tokens = documents(spark, sf_dir, "source", "lang"), raw_tokens(F.col("text"))
    fine = files.materialize(vocabulary.word_sketches(docs, tokens, "source", "lang"), "sketches")
    merged = vocabulary.estimated_vocabulary(vocabulary.merge_sketches(fine, "source"))
    direct = vocabulary.estimated_vocabulary(vocabulary.word_sketches(docs, tokens, "source"))
    # A union is estimated by another formula than one sketch; both keep the bound.
    want = {r.source: r for r in direct.collect()}
    for r in merged.collect():
        assert r.total_tokens == want[r.source].total_tokens
        assert r.approx_vocabulary == pytest.approx(want[r.source].approx_vocabulary, rel=0.02)
    whole = vocabulary.estimated_vocabulary(vocabulary.merge_sketches(fine)).first()
    exact = vocabulary.corpus_totals(vocabulary.word_count(docs, tokens)).first()
    assert whole.total_tokens == exact.total_tokens
    assert whole.approx_vocabulary == pytest.approx(exact.vocabulary, rel=0.03)
    twice = vocabulary.merge_sketches(fine.union(fine))
    again = vocabulary.estimated_vocabulary(twice).first()
    assert (again.approx_vocabulary, again.total_tokens) == (whole.approx_vocabulary, 2 * whole.total_tokens)


def test_sketches_of_nothing(spark):
    empty = spark.createDataFrame([], "text string, source string")
    assert vocabulary.word_sketches(empty, raw_tokens(F.col("text")), "source").count() == 0
    one = vocabulary.merge_sketches(vocabulary.word_sketches(empty, raw_tokens(F.col("text")), "source"))
    assert tuple(vocabulary.estimated_vocabulary(one).first()) == (0, 0)
