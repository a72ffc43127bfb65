"""Records of many layouts, and of none, give one row each; the query deals conversations to all layouts."""

import hashlib
import json
from collections import Counter

from pyspark.sql import functions as F

from matnworks.llm import chat, queries

SCHEMA = "conv_id long, record string"


def formatted(spark, values):
    rows = [(i, v if v is None or isinstance(v, str) else json.dumps(v)) for i, v in enumerate(values)]
    return chat.format_chat(spark.createDataFrame(rows, SCHEMA))


def test_three_records_in_and_three_out(spark):
    out = formatted(spark, [{"id": 7, "prompt": "Q", "completion": "A", "meta": {"a": [1]}}, {"messages": []}, {"prompt": "Q", "completion": "A"}])
    rows = sorted(out.collect())
    assert [r.layout for r in rows] == ["prompt", "messages", "prompt"]
    assert [[(t.role, t.text) for t in r.turns] for r in rows] == [[("user", "Q"), ("assistant", "A")], [], [("user", "Q"), ("assistant", "A")]]
    assert sorted((r.conv_id, r.n_turns) for r in chat.read_back(out).collect()) == [(0, 2), (1, 0), (2, 2)]


def test_odd_records(spark):
    known = {
        0: ({"messages": None}, []),
        1: ({"messages": [{"role": "user"}, {"role": "assistant", "content": None, "weight": 1}]}, [("user", ""), ("assistant", "")]),
        2: ({"prompt": 5, "completion": True}, [("user", "5"), ("assistant", "true")]),
        3: ({"instruction": "I", "input": "", "output": None, "system": "S"}, [("system", "S"), ("user", "I"), ("assistant", "")]),
        4: ({"conversations": [{"from": "tool", "value": "x"}, {"from": "gpt", "value": "y"}]}, [("tool", "x"), ("assistant", "y")]),
        5: ('{"question": "\\ud800", "answer": "\\ud83d\\ude00"}', [("user", "�"), ("assistant", "\U0001f600")]),
        6: ({"prompt": "", "completion": "A"}, [("user", ""), ("assistant", "A")]),
    }
    unknown = [None, "", "no json", "[1]", "3", {}, {"messages": ["hi"]}, {"messages": "hi"}, {"prompt": {"a": 1}, "completion": "A"},
               {"messages": [{"role": ["user"], "content": "x"}]}, {"prompt": "Q"}, {"prompt": "Q", "completion": "A", "turns": []},
               "[" * 100_000]
    out = formatted(spark, [v for v, _ in known.values()] + unknown)
    rows = {r.conv_id: r for r in out.collect()}
    assert len(rows) == len(known) + len(unknown)
    for i, (_, turns) in known.items():
        assert [(t.role, t.text) for t in rows[i].turns] == turns, i
    assert all(rows[i].turns is None and rows[i].layout is None and rows[i].fingerprint for i in range(len(known), len(rows)))
    back = {r.conv_id: r for r in chat.read_back(out).collect()}
    assert len(back) == len(rows) and all((back[i].n_turns is None) == (i >= len(known)) for i in back)


def test_the_query_uses_every_layout(spark, sf_dir):
    big = sf_dir.replace("sf0.001", "sf0.01")
    given = spark.read.parquet(f"{big}/conversations.parquet").select("conv_id", "turn", "role", "text")
    shorter = given.where("role <> 'system' AND turn < 3").selectExpr("conv_id + 100000 AS conv_id", "turn", "role", "text")
    odd = spark.createDataFrame(
        [(None, 0, "user", "null id"), (-1, 0, "human", "a"), (-1, 1, "gpt", None), (-2, None, None, "x"), (-3, 0, "user", ""), (-3, 1, "assistant", "")],
        given.schema,
    )
    rows = given.union(shorter).union(odd)
    out = chat.format_chat(chat.records(rows, chat.MAPPINGS))
    assert set(Counter(r.layout for r in out.select("layout").collect())) == {m.layout for m in chat.MAPPINGS}
    plain: dict = {}
    for r in rows.collect():
        plain.setdefault(r.conv_id, []).append((r.turn is not None, r.turn or 0, r.role or "", r.text or ""))
    found = {r.conv_id: r for r in chat.read_back(out).collect()}
    assert set(found) == set(plain)
    for conv_id, turns in plain.items():
        turns.sort()
        loss = "".join(t for *_, role, t in turns if role == "assistant")
        whole = "".join(f"{role}\n{t}\n" for *_, role, t in turns)
        r = found[conv_id]
        assert (r.n_turns, r.loss_chars) == (len(turns), len(loss))
        assert r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_query_equals_the_plain_contract(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    plain: dict = {-7: [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]}
    for r in given.collect():
        plain.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    found = {r.conv_id: r for r in queries.QUERIES["op3_chat_formatting"](spark, sf_dir).collect()}
    assert set(found) == set(plain)
    for conv_id, turns in plain.items():
        whole = "".join(f"{role}\n{t}\n" for _, role, t in sorted(turns))
        loss = "".join(t for _, role, t in sorted(turns) if role == "assistant")
        assert found[conv_id].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert found[conv_id].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert found[conv_id].loss_chars == len(loss)


def test_a_conversation_of_most_rows_is_cut_into_parts(spark):
    said = F.concat(F.lit("</s>"), F.repeat(F.lit("word "), 20), F.col("id").cast("string"))
    role = F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role")
    hot = spark.range(20_000).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), role, said.alias("text"))
    one_turn = spark.range(3_000).select(
        F.lit(2).cast("long").alias("conv_id"), F.lit(None).cast("long").alias("turn"), F.lit("user").alias("role"), said.alias("text")
    )
    long = spark.range(4).select(F.lit(3).cast("long").alias("conv_id"), F.col("id").alias("turn"), role, F.repeat(F.lit("é"), 900_000).alias("text"))
    small = spark.range(400).select((F.col("id") + 10).alias("conv_id"), F.lit(0).cast("long").alias("turn"), role, said.alias("text"))
    rows = hot.union(one_turn).union(long).union(small).repartition(8, "text")
    written = chat.records(rows, chat.MAPPINGS)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        tasks = [r.p for r in written.where("conv_id = 1").select(F.expr("shiftright(part, 33)").alias("p")).distinct().collect()]
    finally:
        spark.conf.unset(key)
    assert len(tasks) > 1  # small partitions are merged otherwise
    out = chat.format_chat(written)
    sizes = out.select("conv_id", F.size("turns").alias("n")).collect()
    assert max(r.n for r in sizes) <= chat.SEGMENT
    assert sum(r.conv_id == 3 for r in sizes) >= 2  # 1.8 MB of text to a row of it
    plain: dict = {}
    for r in rows.collect():
        plain.setdefault(r.conv_id, []).append((-1 if r.turn is None else r.turn, r.role, r.text))
    found = chat.read_back(out).collect()
    assert len(found) == len(plain) and {r.conv_id for r in found} == set(plain)
    for r in found:
        turns = sorted(plain[r.conv_id])
        loss = "".join(t for _, role, t in turns if role == "assistant")
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{t}\n" for _, a, t in turns).encode()).hexdigest()
        assert (r.n_turns, r.loss_chars) == (len(turns), len(loss))
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.formatted_chars == sum(len(chat.write([(a, t)], "assistant")[0]) for _, a, t in turns)


def test_small_parts_give_the_same_digests(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").withColumn("conv_id", F.col("conv_id") % 3)
    some = {n: sorted(chat.read_back(chat.format_chat(chat.records(given, chat.MAPPINGS, n))).collect()) for n in (1, 2, 7, chat.SEGMENT)}
    assert len(some[1]) == 3 and some[1] == some[2] == some[7] == some[chat.SEGMENT]


def test_an_unknown_part_makes_the_conversation_unknown(spark):
    rows = [(1, 0, '{"turns": []}'), (1, 1, "no json"), (2, 0, '{"turns": []}'), (2, 0, '{"turns": []}'), (None, 0, "x")]
    back = chat.read_back(chat.format_chat(spark.createDataFrame(rows, "conv_id long, part long, record string"))).collect()
    assert sorted((str(r.conv_id), r.n_turns) for r in back if r.n_turns is not None) == [("2", 0), ("2", 0)]
    assert sorted(str(r.conv_id) for r in back if r.n_turns is None) == ["1", "None"]
