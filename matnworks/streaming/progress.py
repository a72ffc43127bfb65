"""Times of micro-batches as the engine reports them.

A listener takes the progress of every completed batch, so a row covers all of it: asking the source, planning,
computing and writing (``foreachBatch`` included), and the two log entries that commit it. ``recentProgress`` of
a query holds the last hundred batches only; the listener writes all, ``HELD`` at a time, next to the results.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.readwriter import DataStreamWriter

HELD = 500
SCHEMA = (
    "batch_id long, started string, input_rows long, trigger_ms long, source_ms long, planning_ms long, "
    "add_batch_ms long, commit_ms long, state_rows long, late_rows long"
)
PARTS = {
    "source_ms": ("latestOffset", "getBatch", "getOffset", "setOffsetRange"),
    "planning_ms": ("queryPlanning",),
    "add_batch_ms": ("addBatch",),
    "commit_ms": ("walCommit", "commitOffsets", "commitBatch"),
}


class BatchTimes(StreamingQueryListener):
    """Rows of ``SCHEMA`` for the batches of one query, appended to ``folder`` as they pile up."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.rows: dict[str, list[tuple]] = {}
        self.query: str | None = None
        self.over: set[str] = set()
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if "addBatch" not in p.durationMs:
            return
        parts = [sum(p.durationMs.get(name, 0) for name in names) for names in PARTS.values()]
        state = [sum(getattr(s, name) for s in p.stateOperators) for name in ("numRowsTotal", "numRowsDroppedByWatermark")]
        row = (p.batchId, p.timestamp, p.numInputRows, p.durationMs["triggerExecution"], *parts, *state)
        with self.changed:
            held = self.rows.setdefault(str(p.id), [])
            held.append(row)
            full = str(p.id) == self.query and len(held) >= HELD
        if full:
            self.write()

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.over.add(str(event.runId))
            self.changed.notify_all()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Events come late; the end of a run is the last of them."""
        with self.changed:
            self.changed.wait_for(lambda: str(query.runId) in self.over, seconds)

    def write(self) -> None:
        with self.changed:
            rows = self.rows.pop(self.query or "", [])
        if rows:
            self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.folder)


def run(spark: SparkSession, writer: DataStreamWriter, folder: str) -> StreamingQuery:
    """Start a query, wait for its end, and keep the times of its batches in ``folder``/progress."""
    times = BatchTimes(spark, f"{folder}/progress")
    spark.streams.addListener(times)
    try:
        query = writer.start()
        times.query = str(query.id)
        try:
            query.awaitTermination()
        finally:
            times.wait(query)
            times.write()
        return query
    finally:
        spark.streams.removeListener(times)


def batch_times(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each batch; of a batch that was repeated after a failure, the last run."""
    rows = spark.read.schema(SCHEMA).parquet(f"{folder}/progress")
    last = rows.groupBy("batch_id").agg(F.max_by(F.struct(*rows.columns[1:]), "started").alias("last"))
    return last.select("batch_id", "last.*")
