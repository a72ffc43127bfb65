"""Nearest neighbours by pruned graphs against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from matnworks.llm import neighbours, queries

SCHEMA = "vec_id long, embedding array<float>"


def cosine(a, b):
    a, b = np.array(a, np.float64), np.array(b, np.float64)
    a, b = a / 2.0 ** math.frexp(np.abs(a).max())[1], b / 2.0 ** math.frexp(np.abs(b).max())[1]
    return a @ b / (np.linalg.norm(a) * np.linalg.norm(b))


def usable(v):
    return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)


def brute(rows, k, asked=lambda i: i % 50 == 0):
    rows = [(i, tuple(v)) for i, v in rows if i is not None and usable(v)]
    out = {}
    for q in sorted({i for i, _ in rows if asked(i)}):
        mine = min(v for i, v in rows if i == q)
        best = {}
        for i, v in rows:
            if i != q and len(v) == len(mine):
                best[i] = max(best.get(i, -2.0), cosine(mine, v))
        out[q] = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
    return out


def searched(rows, k=5, asked="vec_id % 50 = 0"):
    index = neighbours.build(rows, "embedding", k)
    out = {}
    for r in neighbours.neighbours(index, rows.where(asked), "embedding", k).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(found, wanted):
    pairs = sum(map(len, wanted.values()))
    return sum(len({i for i, _ in w} & {i for i, _ in found.get(q, [])}) for q, w in wanted.items()) / pairs


def test_query_on_the_given_vectors(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    wanted = brute(rows, 5)
    found = {}
    for r in queries.QUERIES["op11_pruned_graph_neighbours"](spark, sf_dir).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert found.keys() == wanted.keys() and recall(found, wanted) >= 0.95
    scores = {(q, i): s for q, w in brute(rows, 500).items() for i, s in w}
    for q, pairs in found.items():
        assert len(pairs) == 5 and pairs == sorted(pairs, key=lambda x: (-x[1], x[0]))
        assert all(abs(scores[q, i] - s) < 1e-12 for i, s in pairs)


@pytest.mark.parametrize("shape", ["gauss", "clusters", "near copies"])
def test_recall_over_several_shards(spark, monkeypatch, shape):
    monkeypatch.setattr(neighbours, "SHARD_BYTES", 1000 * (8 * 32 + 4 * neighbours.DEGREE))
    random = np.random.default_rng(3)
    vectors = random.normal(size=(4000, 32))
    if shape == "clusters":
        vectors = 0.2 * vectors + random.normal(size=(40, 32))[np.arange(4000) % 40]
    if shape == "near copies":
        vectors[:1500] = vectors[0] + 1e-4 * random.normal(size=(1500, 32))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors.astype(np.float32))]
    df = spark.createDataFrame(rows, SCHEMA)
    assert neighbours.build(df, "embedding", 5).select("shard").distinct().count() == 4
    assert recall(searched(df), brute(rows, 5)) >= 0.9


def test_few_vectors_give_the_exact_result_with_ties_nulls_and_repeats(spark):
    a, b, c = [1.0, 0.0, 2.0], [0.5, 0.25, -1.0], [0.0, 3.0, 1.0]
    rows = [(0, a), (0, a), (0, b), (50, c), (100, None), (150, [0.0, 0.0, 0.0]), (200, [1.0, None, 2.0]), (None, a)]
    rows += [(250, [1.0, float("nan"), 2.0]), (300, [1.0, float("inf"), 2.0]), (350, []), (400, [3e38, 3e38, -3e38])]
    rows += [(450, [1.0, 2.0]), (451, [2.0, 1.0]), (500, [4.0])]
    rows += [(i, c) for i in range(1000, 1040)] + [(i, [2 * x for x in a]) for i in range(2000, 2003)] + [(5, b), (6, b), (7, a)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"size": F.lit(1), "shard": F.lit("x"), "score": F.lit(None), "ids": F.lit(3)})
    wanted = {q: w for q, w in brute(rows, 5).items() if w}
    found = searched(df)
    assert found.keys() == wanted.keys()
    for q, w in wanted.items():
        assert [i for i, _ in found[q]] == [i for i, _ in w], q
        assert np.allclose([s for _, s in found[q]], [s for _, s in w], rtol=0, atol=1e-12)


def test_one_vector_with_most_rows_is_one_node(spark):
    random = np.random.default_rng(5)
    others = [(i, [float(x) for x in v]) for i, v in enumerate(random.normal(size=(300, 8)).astype(np.float32))]
    hot = others[7][1]
    rows = others + [(i, hot) for i in range(1000, 4000)]
    index = neighbours.build(spark.createDataFrame(rows, SCHEMA), "embedding", 5)
    assert index.count() == 300 and index.agg(F.max(F.size("ids"))).first()[0] == 6
    found = searched(spark.createDataFrame(rows, SCHEMA))
    assert [i for i, _ in found[1000]] == [7, 1001, 1002, 1003, 1004] and [i for i, _ in found[3950]] == [7, 1000, 1001, 1002, 1003]
    assert found.keys() == {q for q in range(4000) if q % 50 == 0 and (q < 300 or q >= 1000)}


def test_hot_vectors_are_cut_before_the_shuffle(spark):
    rows = spark.createDataFrame([(1, [1.0]), (2, [1.0])], SCHEMA)
    from pyspark.sql import Window

    first = Window.partitionBy("vector").orderBy("vec_id")
    few = neighbours.usable(rows, "embedding").distinct().withColumn("place", F.row_number().over(first)).where("place <= 6")
    assert "WindowGroupLimit" in few._jdf.queryExecution().optimizedPlan().toString()


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert searched(empty) == {}
    assert searched(spark.createDataFrame([(1, [1.0]), (3, [2.0])], SCHEMA)) == {}
    assert searched(spark.createDataFrame([(50, [1.0])], SCHEMA)) == {}
