"""Streams with state: running metrics, windows of event time, times of batches, and recovery."""

import pytest
from pyspark.sql import functions as F

from matnworks.operators import cleaning, reports
from matnworks.plans import streams
from matnworks.sources.files import write_parquet
from matnworks.sources.tables import ar_documents, class_labels, labelled
from matnworks.streaming import ingest, progress, scoring, stateful

SCORED = "doc_id long, label int, prediction int"


def rows(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


def scored(spark, ids):
    return spark.createDataFrame([(i, None if i % 11 == 0 else i % 2, i * i % 3 % 2) for i in ids], SCORED).coalesce(1)


def land(spark, path, *deliveries):
    for ids in deliveries:
        scored(spark, ids).write.mode("append").parquet(path)


def counts(spark, path):
    stream = spark.readStream.schema(SCORED).option("maxFilesPerTrigger", 1).parquet(path)
    return stateful.running_counts(stream.withColumn("chunk", F.col("doc_id") % 4), "chunk")


@pytest.mark.parametrize("mode", ["update", "complete"])
def test_state_goes_on_after_a_restart_in_the_middle(spark, tmp_path, mode):
    """Every delivery adds to every chunk, so a restart that lost the state would lose the counts of the first part."""
    path, folder = str(tmp_path / "in"), str(tmp_path / "out")
    parts = [range(0, 30), range(30, 50), range(50, 90), range(90, 95)]
    land(spark, path, *parts[:2])
    stateful.keep_versions(counts(spark, path), folder, mode)
    half = rows(stateful.current(spark, folder, "chunk"))
    land(spark, path, *parts[2:])
    stateful.keep_versions(counts(spark, path), folder, mode)
    whole = scored(spark, range(95)).withColumn("chunk", F.col("doc_id") % 4)
    from matnworks.operators.evaluation import confusion_matrix

    assert rows(stateful.current(spark, folder, "chunk")) == rows(confusion_matrix(whole, "chunk")) != half
    undisturbed = str(tmp_path / "at once")
    stateful.keep_versions(counts(spark, path), undisturbed, mode)
    assert rows(stateful.current(spark, undisturbed, "chunk")) == rows(stateful.current(spark, folder, "chunk"))
    assert progress.batch_times(spark, folder).count() == 4


def test_update_mode_writes_changed_keys_only_and_versions_can_be_merged(spark, tmp_path):
    path, folder = str(tmp_path / "in"), str(tmp_path / "out")
    land(spark, path, range(0, 20), [40], [41], [44, 41 + 4])
    stateful.keep_versions(counts(spark, path), folder)
    sizes = {r.batch_id: r["count"] for r in spark.read.parquet(f"{folder}/versions").groupBy("batch_id").count().collect()}
    assert sizes == {0: 4, 1: 1, 2: 1, 3: 2}
    before = rows(stateful.current(spark, folder, "chunk"))
    assert stateful.compact(spark, folder, "chunk") == 2
    assert rows(stateful.current(spark, folder, "chunk")) == before
    assert {r.batch_id for r in spark.read.parquet(f"{folder}/versions").select("batch_id").collect()} == {2, 3}
    land(spark, path, range(60, 70))
    stateful.keep_versions(counts(spark, path), folder)
    assert sum(r[0] for r in rows(stateful.current(spark, folder, "chunk").select(F.expr("TP + TN + FP + FN + n_unlabelled")))) == 34


def test_a_batch_that_fails_before_its_version_is_written_counts_once(spark, tmp_path, monkeypatch):
    path, folder = str(tmp_path / "in"), str(tmp_path / "out")
    land(spark, path, range(0, 20), range(20, 40), range(40, 60))
    stream = counts(spark, path).withColumn("n", F.expr("TP + TN + FP + FN + n_unlabelled"))
    broken = stream.withColumn("n", F.when(F.col("n") > 8, F.raise_error(F.lit("lost"))).otherwise(F.col("n")))
    with pytest.raises(Exception, match="lost"):
        stateful.keep_versions(broken, folder)
    assert {r.n for r in stateful.current(spark, folder, "chunk").collect()} == {5}
    stateful.keep_versions(stream, folder)
    assert {r.n for r in stateful.current(spark, folder, "chunk").collect()} == {15}


EVENTS = "at timestamp, kind string, value double"


def land_events(spark, path, *batches):
    for batch in batches:
        made = spark.createDataFrame([(t, k, v) for t, k, v in batch], "t string, kind string, value double")
        made.select(F.to_timestamp("t").alias("at"), "kind", "value").coalesce(1).write.mode("append").parquet(path)


def windows(spark, path, late="30 minutes"):
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(path)
    return stateful.event_windows(stream, "at", "1 hour", late, "kind", total=F.sum("value"))


BATCHES = [
    [("2024-01-01 10:05:00", "a", 1.0), ("2024-01-01 10:50:00", "b", 2.0), (None, "a", 9.0)],
    [("2024-01-01 12:00:00", "a", 4.0)],  # moves the watermark to 11:30
    [("2024-01-01 12:10:00", "a", 64.0)],  # closes the window of ten; the next batch is the first that it bars
    [("2024-01-01 10:59:00", "a", 8.0), ("2024-01-01 11:40:00", "b", 16.0)],  # too late; late but in time
    [("2024-01-01 18:00:00", "a", 32.0)],
]


def test_rows_behind_the_watermark_are_dropped_and_counted(spark, tmp_path):
    path, folder = str(tmp_path / "in"), str(tmp_path / "out")
    land_events(spark, path, *BATCHES)
    stateful.keep_versions(windows(spark, path), folder)
    found = stateful.current(spark, folder, "window_start", "window_end", "kind")
    shown = [(r.window_start.hour, r.kind, r.n, r.total) for r in found.collect()]
    assert sorted(shown) == [(10, "a", 1, 1.0), (10, "b", 1, 2.0), (11, "b", 1, 16.0), (12, "a", 2, 68.0), (18, "a", 1, 32.0)]
    times = {r.batch_id: r for r in progress.batch_times(spark, folder).collect()}
    assert sum(r.late_rows for r in times.values()) == 1 and times[3].late_rows == 1


def test_nothing_is_late_within_the_watermark(spark, tmp_path):
    path, folder = str(tmp_path / "in"), str(tmp_path / "out")
    land_events(spark, path, *BATCHES)
    stateful.keep_versions(windows(spark, path, "1 day"), folder)
    found = stateful.current(spark, folder, "window_start", "window_end", "kind")
    assert (10, "a", 2, 9.0) in [(r.window_start.hour, r.kind, r.n, r.total) for r in found.collect()]
    assert progress.batch_times(spark, folder).agg(F.sum("late_rows")).first()[0] == 0


def test_closed_windows_are_appended_once_and_leave_the_state(spark, tmp_path):
    path, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    land_events(spark, path, *BATCHES[:3])
    ingest.append_parquet(windows(spark, path), out, checkpoint)
    shown = lambda: sorted((r.window_start.hour, r.kind, r.n) for r in spark.read.parquet(out).collect())
    first = shown()
    assert first == [(10, "a", 1), (10, "b", 1)]
    land_events(spark, path, *BATCHES[3:])
    query = ingest.append_parquet(windows(spark, path), out, checkpoint)
    assert shown() == [*first, (11, "b", 1), (12, "a", 2)]
    assert query.lastProgress.stateOperators[0].numRowsTotal == 1


def test_times_of_more_batches_than_the_query_remembers(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(progress, "HELD", 40)
    path, folder = str(tmp_path / "in"), str(tmp_path / "out")
    ids = [(i, i % 2, 0) for i in range(105)]
    spark.createDataFrame(ids, SCORED).repartition(105, "doc_id").write.option("maxRecordsPerFile", 1).parquet(path)
    stream = spark.readStream.schema(SCORED).option("maxFilesPerTrigger", 1).parquet(path)
    writer = stream.writeStream.foreachBatch(lambda batch, n: batch.collect() and None).trigger(availableNow=True)
    query = progress.run(spark, writer.option("checkpointLocation", f"{folder}/checkpoint"), folder)
    times = progress.batch_times(spark, folder)
    out = times.orderBy("batch_id").collect()
    assert [r.batch_id for r in out] == list(range(105)) and len(query.recentProgress) <= 100
    assert sum(r.input_rows for r in out) == 105
    assert all(r.trigger_ms >= r.add_batch_ms + r.commit_ms and r.commit_ms >= 0 for r in out)
    assert len(spark.read.parquet(f"{folder}/progress").inputFiles()) == 3


def test_latency_covers_counts_and_commit(spark, tmp_path, monkeypatch):
    import time

    path, folder = str(tmp_path / "in"), str(tmp_path / "out")
    land(spark, path, range(0, 20), range(20, 40))
    slow = scoring.confusion_matrix
    monkeypatch.setattr(scoring, "confusion_matrix", lambda *a: (time.sleep(0.7), slow(*a))[1])
    stream = spark.readStream.schema(SCORED).option("maxFilesPerTrigger", 1).parquet(path)
    scoring.score_stream(stream, lambda batch: batch, folder)
    out = scoring.batch_metrics(spark, folder).collect()
    assert len(out) == 2 and all(r.latency_ms > 700 and r.throughput_rps > 0 for r in out)


def test_failure_between_the_two_writes_and_restart_of_the_real_query(spark, sf_dir, tmp_path, monkeypatch):
    """The scores of a batch are written, its counts are not; the query starts again from its checkpoint."""
    corpus = labelled(ar_documents(spark, sf_dir), class_labels(spark, sf_dir)).withColumn("batch", F.col("doc_id") % 3)
    path = str(tmp_path / "in")
    write_parquet(corpus.repartition(4, "doc_id"), path)

    def score(batch):
        out = reports.score_linear(cleaning.with_features(batch))
        return out.select("doc_id", "text", "label", "batch", "margin", "prediction")

    def run(folder):
        stream = spark.readStream.schema(corpus.schema).option("maxFilesPerTrigger", 1).parquet(path)
        return scoring.score_stream(stream, score, folder, key="batch")

    folder, clean = str(tmp_path / "out"), str(tmp_path / "clean")
    counted, calls = scoring.confusion_matrix, []

    def fails_at_the_third(*args):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("lost between the writes")
        return counted(*args)

    monkeypatch.setattr(scoring, "confusion_matrix", fails_at_the_third)
    with pytest.raises(Exception, match="lost between"):
        run(folder)
    assert scoring.scored_rows(spark, folder).select("batch_id").distinct().count() == 3
    assert spark.read.parquet(f"{folder}/counts").select("batch_id").distinct().count() == 2
    run(folder)
    run(clean)
    # The path names hold the batch ids, and file order is the same, so even batch ids are equal.
    assert rows(scoring.scored_rows(spark, folder)) == rows(scoring.scored_rows(spark, clean))
    assert rows(scoring.key_metrics(spark, folder, "batch")) == rows(scoring.key_metrics(spark, clean, "batch"))
    assert progress.batch_times(spark, folder).count() == 4


def test_deliveries_are_spread_over_files():
    assert streams.files_per_delivery(1_000, 8) == 1
    assert streams.files_per_delivery(10_000, 8) == 8
    assert streams.files_per_delivery(10**9, 8) == 1_000
    assert streams.files_per_delivery(0, 8) == 1


def test_event_windows_of_the_given_table(spark, sf_dir):
    found = streams.stream_event_windows(spark, sf_dir)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    assert found.agg(F.sum("n")).first()[0] == events.where("ts IS NOT NULL").count()
