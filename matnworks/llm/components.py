"""Connected components by minimum labels, as joins and combined aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matnworks.sources import files


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a``, ``b``): the smallest node that is reachable.

    Each round takes the smallest label over the edges, lets whole trees follow their root, and halves
    paths, so the number of rounds is logarithmic. Labels are written to the shared folder after each
    round. Nodes with many edges are combined before the shuffle; no neighbour list is ever collected.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct()
    both = files.materialize(both, "edges")
    labels = both.groupBy("a").agg(F.least("a", F.min("b")).alias("l")).select(F.col("a").alias("node"), "l")
    labels = files.materialize(labels, "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("l").alias("m"))
        seen = labels.join(near.withColumnRenamed("a", "node"), "node")
        seen = files.materialize(seen.select("node", "l", F.least("l", "m").alias("m")), "labels")
        roots = seen.groupBy("l").agg(F.min("m").alias("r"))
        hooked = seen.join(roots, "l").select("node", "l", F.least("m", "r").alias("h"))
        hooked = files.materialize(hooked, "labels")
        up = hooked.select(F.col("node").alias("h"), F.col("h").alias("top"))
        stepped = hooked.join(up, "h").select("node", F.least("h", "top").alias("l"), (F.col("l") != F.least("h", "top")).alias("changed"))
        stepped = files.materialize(stepped, "labels")
        labels = stepped.select("node", "l")
        if stepped.where("changed").isEmpty():
            return labels.withColumnRenamed("l", "component")
