"""Conversation repair against an exhaustive search of edits."""

import hashlib
import itertools
import re
import zlib

import pytest
from pyspark.sql import functions as F

from matnworks.llm import queries, repair

SCHEMA = "conv_id long, turn long, role string, text string"
FULL = re.compile(r"(s?(ua)+)?")
WORD = re.compile(r"[^\x20\x09-\x0D]")


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        n = zlib.crc32(key.encode()) % 20
        if n == 0:
            continue
        text = "" if n == 1 else re.sub("[.!?]", "", text) if n == 2 else text
        out += [(conv, turn, "user" if n == 4 else role, text)] * (2 if n == 3 else 1)
    return out


def faults_of(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        words = WORD.findall(text)
        out.append(
            "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else ""
        )
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """All edit sequences with at most two inserts in a row, by plain search over (cost, letters, result)."""
    level = {("", ()): (0, "")}  # initials, messages -> least cost and letters
    for row, fault in [*zip(rows, faults, strict=True), (None, None)]:
        grown = {}

        def put(key, value, into=grown):
            if value < into.get(key, (10**9, "")):
                into[key] = value

        for (initials, messages), (cost, letters) in level.items():
            for n in range(3):
                for inserted in itertools.product(("user", "assistant"), repeat=n):
                    i2 = initials + "".join(x[0] for x in inserted)
                    m2, c2, l2 = messages + tuple((x, "") for x in inserted), cost + 2 * n, letters + "I" * n
                    if row is None:
                        put((i2, m2), (c2, l2))
                        continue
                    put((i2, m2), (c2 + 3, l2 + "D"))
                    if fault in ("blank", "duplicate"):
                        continue
                    more = int(fault == "truncated")
                    if row[2]:
                        put((i2 + row[2][:1], m2 + ((row[2], row[3]),)), (c2 + more, l2 + "K"))
                    for role in ("user", "assistant"):
                        put((i2 + role[0], m2 + ((role, row[3]),)), (c2 + 2 + more, l2 + "R"))
        level = {k: v for k, v in grown.items() if re.fullmatch(r"(s?(ua)*u?)?", k[0])}
    return min((v, k[1]) for k, v in level.items() if FULL.fullmatch(k[0]))


def plain_report(conv, rows):
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    faults = faults_of(rows)
    initials = [r[2][:1] for r in rows]
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    (cost, letters), messages = cheapest(rows, faults)
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in messages).encode()).hexdigest()
    return (conv, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, letters, digest)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def expected(rows):
    convs = {r[0]: [] for r in rows}
    for r in rows:
        convs[r[0]].append(r)
    return sorted((plain_report(c, x) for c, x in convs.items()), key=repr)


def reported(found):
    return sorted((tuple(r) for r in found.reports().select(*COLUMNS).collect()), key=repr)


ROLES = ["user", "assistant", "system", "user", "assistant", "tool", "", " ", "sys", "User"]


def conversations(count, longest):
    value = 1
    for conv in range(count):
        value = value * 48271 % 2147483647
        for i in range(value % (longest + 1)):
            value = value * 48271 % 2147483647
            text = ["Yes.", "Why?\n", "cut off", "", " \t", "Yes.", "é ü", "ok!\x0b"][value % 8]
            turn = None if value // 8 % 11 == 0 else i + (value // 64 % 3 == 0) * 2
            yield conv if conv else None, turn, ROLES[value // 1000 % len(ROLES)], text


def test_repair_equals_exhaustive_search(spark):
    rows = list(conversations(60, 6))
    assert reported(repair.repair(spark.createDataFrame(rows, SCHEMA))) == expected(rows)


@pytest.mark.parametrize("size", [1, 2, 3])
def test_segments_of_any_size_give_the_same(spark, shuffle_partitions, size):
    shuffle_partitions(5)
    rows = list(conversations(25, 7))
    df = spark.createDataFrame(rows, SCHEMA)
    assert reported(repair.repair(df, size)) == expected(rows) == reported(repair.repair(df))


def plain_dynamic(kinds):
    """Cost and letters of a long conversation: a table of (cost, letters) for each state."""
    best = {0: (0, "")}
    for kind in kinds:
        grown = {}
        for state, (cost, letters) in best.items():
            at, n = state, 0
            for n in range(3):
                ways = [(at, 3, "D")]
                follow = 3 if at == 2 else 2
                if kind != "D":
                    extra = int(kind.isupper())
                    ways.append((follow, 2 + extra, "R"))
                    if kind.lower() == ("a" if at == 2 else "u"):
                        ways.append((follow, extra, "K"))
                    elif kind.lower() == "s" and at == 0:
                        ways.append((1, extra, "K"))
                for to, more, letter in ways:
                    value = (cost + 2 * n + more, letters + "I" * n + letter)
                    grown[to] = min(value, grown.get(to, value))
                at = follow
        best = grown
    closing = {0: "", 1: "II", 2: "I", 3: ""}
    return min((c + 2 * len(closing[s]), x + closing[s]) for s, (c, x) in best.items())


def test_one_conversation_with_most_rows_is_cut_and_joined(spark, shuffle_partitions):
    shuffle_partitions(7)
    value, rows = 7, [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes.")]
    for i in range(3000):
        value = value * 48271 % 2147483647
        rows.append((5, i, ["user", "assistant", "system", "tool"][value % 4], f"Text {i}" + ".!,"[value // 7 % 3]))
    rows += [(9, i, "user" if i % 2 == 0 else "assistant", f"{i}.") for i in range(4)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = repair.repair(spark.createDataFrame(rows, SCHEMA), 64)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found.segments.where("conv_id = 5").select("part").distinct().count() > 1
    kinds = [r[2][0].replace("t", "x") if r[3][-1] != "," else r[2][0].replace("t", "x").upper() for r in rows if r[0] == 5]
    report = {r.conv_id: r for r in found.reports().collect()}
    assert (report[5].cost, report[5].audit) == plain_dynamic(kinds)
    assert (report[1].cost, report[1].audit, report[9].cost, report[9].audit) == (0, "KK", 0, "KKKK")
    messages = [tuple(r)[2:] for r in found.messages().where("conv_id = 5").orderBy("position").collect()]
    assert FULL.fullmatch("".join(r[0] for r, _ in messages)) and len(messages) == report[5].n_messages
    assert hashlib.sha256("\n".join(f"{r}:{t}" for r, t in messages).encode()).hexdigest() == report[5].repaired_sha256


def test_repeated_rows_long_texts_empty_tables_and_other_columns(spark):
    many = [(1, 0, "user", "Same.")] * 700 + [(1, 1, "assistant", "x" * 3_000_000 + ".")]
    df = spark.createDataFrame(many, SCHEMA).withColumns({"part": F.lit(1), "seq": F.lit("x"), "seen": F.lit(2), "copies": F.lit(0)})
    row = repair.repair(df).reports().first()
    assert (row.duplicate, row.cost, row.audit) == (699, 3 * 699, "K" + "D" * 699 + "K")
    assert (row.gaps, row.illegal) == (0, 699)
    assert repair.repair(spark.createDataFrame([], SCHEMA)).reports().collect() == []


def test_query_damages_and_repairs_all_conversations(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    hurt = plain_damage(rows)
    convs = {r[0]: [] for r in rows}
    for r in hurt:
        convs[r[0]].append(r)
    found = queries.QUERIES["op12_conversation_repair"](spark, sf_dir).select(*COLUMNS).collect()
    assert sorted(tuple(r) for r in found) == sorted(plain_report(c, x) for c, x in convs.items())


def test_conversations_that_lose_all_rows_are_returned(spark, tmp_path):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    spark.createDataFrame([(gone, 0, "user", "Hi."), (None, None, None, None)], SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    found = {r.conv_id: r for r in queries.QUERIES["op12_conversation_repair"](spark, str(tmp_path)).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert tuple(found[gone])[1:] == (0, 0, 0, 0, 0, 0, "", empty)
    assert found[None].blank == 1 and found[None].audit == "D" and found[None].repaired_sha256 == empty
