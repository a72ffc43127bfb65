"""The pipeline against a plain version of its stages, on a small folder of tables."""

import re

import pytest

import corpus_pipeline
from matnworks.llm.lines import WHITE
from test_against_brute_force import LOW, ROWS, check_packing, words

WANTED = ["quality rules", "line dedup", "near dedup", "decontamination", "packing"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, t, "en", f"src{i % 2}", len(t or "")) for i, t in ROWS]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{path}/documents.parquet")
    item = " ".join(max((t or "" for _, t in ROWS[8:40]), key=len).split()[15:40])
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, item


LIMITS = {3: 40, 5: 36, 8: 32, 12: 28}


def kept_by_quality(text):
    w = words(text)
    chars = sum(map(len, w))

    def covered(n):
        grams = [tuple(w[p : p + n]) for p in range(len(w) - n + 1)]
        counts = {}
        for g in grams:
            counts[g] = counts.get(g, 0) + 1
        return {p + k for p, g in enumerate(grams) if counts[g] > 1 for k in range(n)}

    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        repeated += sum(map(len, words(line))) if line in seen else 0
        seen.add(line)
    bad = len(w) < 50 or 100 * len(covered(3)) > 50 * len(w) or 100 * repeated > 20 * chars
    return not bad and all(100 * sum(len(w[p]) for p in covered(n)) <= limit * chars for n, limit in LIMITS.items())


def plain_pipeline(item):
    docs = {i: t for i, t in ROWS if kept_by_quality(t)}
    cut = lambda t: {x.strip(WHITE) for x in t.split("\n") if x.strip(WHITE)}
    hosts = {h: {t for i, t in docs.items() if i % 2 == h} for h in (0, 1)}
    for i, text in list(docs.items()):
        own = hosts[i % 2]
        bad = {x for x in cut(text) if sum(x in cut(o) for o in own) > max(1, 0.1 * len(own))}
        docs[i] = "\n".join(x for x in text.split("\n") if x.strip(WHITE) not in bad)
    sets = {}
    for i, text in docs.items():
        w = words(text.translate(LOW))
        sets[i] = {tuple(w[p : p + 5]) for p in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    label = {i: i for i in docs}
    for _ in range(len(docs)):
        before = dict(label)
        for a in docs:
            for b in docs:
                if a != b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
        if label == before:
            break
    docs = {i: t for i, t in docs.items() if label[i] == i}
    tokens = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(LOW))
    w = tokens(item)
    windows = {tuple(w[p : p + 10]) for p in range(len(w) - 9)}
    clean = {}
    for i, text in docs.items():
        own = tokens(text)
        if not any(tuple(own[p : p + 10]) in windows for p in range(len(own) - 9)):
            clean[i] = text
    return clean


def test_pipeline(spark, folder):
    path, item = folder
    assert [name for name, _ in corpus_pipeline.STAGES] == WANTED
    expected = plain_pipeline(item)
    assert 5 < len(expected) < len(ROWS) - 30
    rows = corpus_pipeline.run(spark, path).collect()
    assert {r.doc_id for r in rows} == set(expected)
    sequences, tokens = check_packing(rows, list(expected.items()))
    assert sequences <= 1.05 * tokens / 1024 + 1


def test_stages_keep_the_columns_and_take_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder[0])
        assert out.count() == 0
        if name != WANTED[-1]:
            assert out.schema.names == docs.schema.names
            assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
