"""Approximate nearest neighbours by robust-pruned directed graphs, one for each shard.

Different vectors are dealt to shards by their hash. In a shard, vectors enter the graph in batches: a greedy beam
search from the entry node proposes neighbours, and pruning keeps the nearest, leaves out what is much nearer
to a kept one than to the node (``ALPHA`` relaxes this, so edges stay diverse and paths short), and goes on with
the rest. Edges are also added backwards, and a list that grows too long is pruned again. A query searches
the graph of every shard with a beam, and the best of all shards are its neighbours.

Equal vectors are one node: a hot vector would make its shard a heap of copies without edges. A node carries
the ``k + 1`` smallest ids of its vector, more cannot be among ``k`` neighbours; Spark cuts longer groups
before its shuffle. A shard holds about ``SHARD_BYTES`` of vectors and edges, so the memory of a task does not grow;
queries come in blocks of about ``BLOCK`` rows. Vectors of different lengths never meet.

Nearness is the cosine, computed from the given vectors in double precision; each vector is first scaled by a power
of two, which changes no bit of the result and keeps squares finite. Null, empty or zero vectors, vectors with null
or non-finite components, and rows without ``vec_id`` take no part. An id with several vectors is one candidate
for each of them (the best counts), and a query by its smallest vector; no row is a candidate for its own id.
Ties go to the smaller id. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matnworks.sources import files

DEGREE = 32
BEAM = 48
ALPHA = 1.2
SEARCH_BEAM = 100
SHARD_BYTES = 5 << 20
BLOCK = 20_000
BATCH = 512

INDEX = "size int, shard int, node int, ids array<long>, vector array<double>, edges array<int>"
FOUND = "query_id long, vec_id long, score double"


# ---------------------------------------------------------------- the graph of a shard


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that their largest component is between 1/2 and 1."""
    _, power = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))
    return np.ldexp(vectors, -power)


def unit(vectors: np.ndarray) -> np.ndarray:
    rows = scaled(vectors)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def search(points: np.ndarray, edges: np.ndarray, entry: np.ndarray, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` nearest nodes that a greedy walk meets, nearest first, and their similarities; missing: -1.

    All queries walk in step. ``edges`` has a row of neighbours for each node, missing ones are -1.
    """
    count, n = len(queries), len(points)
    beam = min(beam, n)
    start = entry[: beam]
    ids = np.full((count, beam), -1, np.int32)
    near = np.full((count, beam), -np.inf)
    done = np.zeros((count, beam), bool)
    met = np.zeros((count, n + 1), bool)
    met[:, n] = True
    ids[:, : len(start)] = start
    near[:, : len(start)] = queries @ points[start].T
    met[:, start] = True
    order = np.argsort(-near, axis=1, kind="stable")
    ids, near = np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)
    at = np.arange(count)
    while len(at):
        open_ = ~done[at] & (ids[at] >= 0)
        go = open_.any(axis=1)
        at, first = at[go], open_[go].argmax(axis=1)
        if not len(at):
            break
        done[at, first] = True
        next_ = edges[ids[at, first]]
        fresh = ~met[at[:, None], next_]
        met[at[:, None], next_] = True
        met[:, n] = True
        width = int(fresh.sum(axis=1).max())
        if not width:
            continue
        pick = np.argsort(~fresh, axis=1, kind="stable")[:, :width]
        next_, fresh = np.take_along_axis(next_, pick, 1), np.take_along_axis(fresh, pick, 1)
        value = np.matmul(points[next_], queries[at][:, :, None])[:, :, 0]
        value[~fresh] = -np.inf
        both = np.concatenate([near[at], value], axis=1)
        ids_both = np.concatenate([ids[at], np.where(fresh, next_, -1)], axis=1)
        done_both = np.concatenate([done[at], np.zeros(fresh.shape, bool)], axis=1)
        best = np.argsort(-both, axis=1, kind="stable")[:, :beam]
        near[at], ids[at] = np.take_along_axis(both, best, 1), np.take_along_axis(ids_both, best, 1)
        done[at] = np.take_along_axis(done_both, best, 1)
    return ids, near


def different(lists: np.ndarray) -> np.ndarray:
    """The lists, sorted, with repeated entries replaced by -1."""
    ordered = np.sort(lists, axis=1)
    ordered[:, 1:][ordered[:, 1:] == ordered[:, :-1]] = -1
    return ordered


def pruned(points: np.ndarray, nodes: np.ndarray, proposed: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """At most ``degree`` of the ``proposed`` neighbours of each node (-1: none): near ones in different directions."""
    count, width = proposed.shape
    ordered = different(proposed)
    ordered[ordered == nodes[:, None]] = -1
    here, there = points[nodes], points[ordered]
    far = 2 - 2 * np.matmul(there, here[:, :, None])[:, :, 0]
    far[ordered < 0] = np.inf
    by = np.argsort(far, axis=1, kind="stable")
    ordered, far = np.take_along_axis(ordered, by, 1), np.take_along_axis(far, by, 1)
    there = np.take_along_axis(there, by[:, :, None], 1)
    apart = 2 - 2 * np.matmul(there, there.transpose(0, 2, 1))
    alive = ordered >= 0
    out = np.full((count, degree), -1, np.int32)
    rows = np.arange(count)
    for i in range(degree):
        some = alive.any(axis=1)
        if not some.any():
            break
        pick = alive.argmax(axis=1)
        out[some, i] = ordered[rows, pick][some]
        # Squared distances: alpha relaxes distances, alpha squared their squares.
        alive &= alpha * alpha * apart[rows, pick] > far
        alive[rows, pick] = False
    return out


def graph(points: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA) -> tuple[np.ndarray, np.ndarray]:
    """Neighbours of each node and the entry nodes, the ones nearest to the mean first."""
    n = len(points)
    middle = points.mean(axis=0)
    entry = np.argsort(-(points @ middle), kind="stable")[:1].astype(np.int32)
    edges = np.full((n, degree), -1, np.int32)
    order = np.random.default_rng(7).permutation(n).astype(np.int32)
    order = np.concatenate([entry, order[order != entry[0]]])
    at = 1
    while at < n:
        batch = order[at : at + max(1, min(BATCH, at))]
        ids, _ = search(points, edges, entry, points[batch], beam)
        # Nodes of one batch cannot meet in the graph yet, so its nearest ones are proposed as well.
        among = points[batch] @ points[batch].T
        np.fill_diagonal(among, -np.inf)
        near = np.argsort(-among, axis=1, kind="stable")[:, : degree // 2]
        edges[batch] = pruned(points, batch, np.concatenate([ids, batch[near].astype(np.int32)], axis=1), degree, alpha)
        sources, targets = np.repeat(batch, degree), edges[batch].ravel()
        sources, targets = sources[targets >= 0], targets[targets >= 0]
        back(points, edges, sources, targets, degree, alpha)
        at += len(batch)
    return edges, entry


def back(points: np.ndarray, edges: np.ndarray, sources: np.ndarray, targets: np.ndarray, degree: int, alpha: float) -> None:
    """Add the edges from ``targets`` back to ``sources``; lists that are full are pruned, all new ones considered."""
    by = np.argsort(targets, kind="stable")
    sources, targets = sources[by], targets[by]
    nodes, first, counts = np.unique(targets, return_index=True, return_counts=True)
    # Lists with many new edges are wide; lists of like width are pruned together.
    for low, high in ((0, 8), (8, 32), (32, 128), (128, len(sources) + 1)):
        some = np.flatnonzero((counts > low) & (counts <= high))
        for part in np.array_split(some, -(-len(some) * min(high, counts.max()) // (BATCH * 32)) or 1):
            if not len(part):
                continue
            width = int(counts[part].max())
            place = np.arange(width)
            new = np.where(place < counts[part][:, None], sources[np.minimum(first[part][:, None] + place, len(sources) - 1)], -1)
            proposed = different(np.concatenate([edges[nodes[part]], new.astype(np.int32)], axis=1))
            room = (proposed >= 0).sum(axis=1) <= degree
            if room.any():
                packed = np.argsort(proposed[room] < 0, axis=1, kind="stable")[:, :degree]
                edges[nodes[part][room]] = np.take_along_axis(proposed[room], packed, 1)
            if not room.all():
                edges[nodes[part][~room]] = pruned(points, nodes[part][~room], proposed[~room], degree, alpha)


# ---------------------------------------------------------------- Spark


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """``vec_id, vector`` (doubles) of the rows that take part."""
    kept = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    good = F.expr("forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))")
    return kept.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).where(
        good & F.expr("exists(vector, x -> x <> 0)")
    )


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.array(column.combine_chunks().flatten().to_numpy()).reshape(len(column), -1)


def build(rows: DataFrame, vector: str, k: int) -> DataFrame:
    """The index, written: for each shard its nodes with ids, vector and edges; the entry is node 0."""
    valid = usable(rows, vector)
    first = Window.partitionBy("vector").orderBy("vec_id")
    # Rows of one id and vector may repeat; they are dropped before ids are counted.
    few = valid.distinct().withColumn("place", F.row_number().over(first)).where(F.col("place") <= k + 1)
    nodes = few.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    nodes = files.materialize(nodes.withColumn("size", F.size("vector")), "vectors")
    sizes = {r["size"]: r["n"] for r in nodes.groupBy("size").agg(F.count("*").alias("n")).collect()}
    shards = {size: -(-n * (8 * size + 4 * DEGREE) // SHARD_BYTES) for size, n in sizes.items()}

    def make(table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending")])
        vectors = matrix(table.column("vector"))
        points = unit(vectors)
        edges, entry = graph(points)
        # The entry becomes node 0.
        order = np.concatenate([entry, np.delete(np.arange(len(points)), entry)])
        place = np.empty(len(points) + 1, np.int32)
        place[order] = np.arange(len(points))
        place[-1] = -1
        return pa.table(
            {
                "size": table.column("size"),
                "shard": table.column("shard"),
                "node": pa.array(np.arange(len(points)), pa.int32()),
                "ids": table.column("ids").take(order),
                "vector": table.column("vector").take(order),
                "edges": pa.array(list(place[edges[order]]), pa.list_(pa.int32())),
            }
        )

    if not shards:
        return nodes.sparkSession.createDataFrame([], INDEX)
    of_size = F.create_map(*[F.lit(int(x)) for pair in shards.items() for x in pair])
    key = F.xxhash64("vector")
    dealt = nodes.withColumns({"key": key, "shard": F.pmod(F.xxhash64(key), of_size[F.col("size")]).cast("int")})
    return files.materialize(dealt.groupBy("size", "shard").applyInArrow(make, INDEX), "index")


def neighbours(index: DataFrame, queries: DataFrame, vector: str, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest candidates found of each row of ``queries``."""
    asked = usable(queries, vector).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vector").alias("vector"))
    asked = files.materialize(asked.withColumn("size", F.size("vector")), "queries")
    blocks = max(1, -(-asked.count() // BLOCK))
    shards = index.groupBy("size").agg((F.max("shard") + 1).alias("shards"))
    # Every block of queries meets every shard of its size.
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")).join(F.broadcast(shards), "size")
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    held = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def find(shard: pa.Table, block: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if shard.num_rows and block.num_rows:
            shard = shard.sort_by([("node", "ascending")])
            vectors, edges = matrix(shard.column("vector")), shard.column("edges").combine_chunks()
            edges = np.array(edges.flatten().to_numpy()).reshape(shard.num_rows, -1)
            points, ids = unit(vectors), shard.column("ids").to_pylist()
            vectors = scaled(vectors)
            norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
            asked_ids = block.column("query_id").to_pylist()
            wanted = matrix(block.column("vector"))
            for at in range(0, len(asked_ids), BATCH):
                some = wanted[at : at + BATCH]
                nodes, _ = search(points, edges, np.zeros(1, np.int32), unit(some), max(SEARCH_BEAM, 2 * k + 2))
                for query, row, found in zip(asked_ids[at : at + BATCH], scaled(some), nodes, strict=True):
                    found = found[found >= 0]
                    score = np.einsum("ij,j->i", vectors[found], row) / (norms[found] * np.sqrt(np.einsum("i,i", row, row)))
                    best = np.argsort(-score, kind="stable")
                    # Ties at the end of the list stay in.
                    least = score[best[min(k, len(best) - 1)]]
                    for i in best[score[best] >= least]:
                        out += [(query, vec_id, float(score[i])) for vec_id in ids[found[i]] if vec_id != query]
        types = [pa.int64(), pa.int64(), pa.float64()]
        columns = zip(*out, strict=True) if out else [[], [], []]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["query_id", "vec_id", "score"])

    groups = [x.groupBy("size", "shard", "block") for x in (held, asked.select("query_id", "vector", "size", "shard", "block"))]
    found = groups[0].cogroup(groups[1]).applyInArrow(find, FOUND)
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
