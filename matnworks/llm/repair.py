"""Conversation structure repair by the cheapest edits.

A repaired conversation has the role initials ``(s?(ua)+)?``. Edits, in the order of the rows: Keep costs 0,
Rerole (to user or assistant) 2, Delete 3, Insert (an empty user or assistant row) 2; a row that stays although
its end is missing adds 1, and blank or repeated rows must be deleted. Of the cheapest edits those with the
ASCII-least letters (D, I, K, R) are taken.

The weight of an edit is one integer: its high digits are the cost, its low digits its letters at fixed
positions. The gap before a row and the row itself own a field of three octal digits, filled from the left and
padded with zeros at the end; no filled field is the beginning of another one, so integers compare as "cost,
then letters" and a plain integer minimum over a directed acyclic graph of (row, last role) decides everything.

A conversation is cut into segments of at most ``SEGMENT`` rows or ``SEGMENT_CHARS`` characters. A segment knows the
least weight from each state to each state, so segments of one conversation are computed by different tasks; what
meets in one task is 16 integers for each segment, and the final letters, never the texts of a conversation.
Rows reach segments by ranges of (conversation, turn, beginnings of role and text), repeated rows as one row with
a count.

Nulls: a null role or text is one space, so a null text is blank; a null ``conv_id`` is a conversation of its
own; null turns come first and leave gaps alone. Rows of one turn are ordered by role and text. A row that
repeats role and text of an earlier row, exact repeats included, is a duplicate. Roles that do not begin with
s, u or a are reroled or deleted. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matnworks.llm.words import slices
from matnworks.llm.worker import keep
from matnworks.sources import files

SEGMENT = 256
SEGMENT_CHARS = 1 << 20
FIELD = 9
LETTERS = " DIKR"
BLANKS = " \t\n\v\f\r"
REMEMBERED = 50_000

# States: nothing yet, after a system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
KEPT = {(START, "s"): SYSTEM, **{(s, "a" if s == USER else "u"): t for s, t in NEXT.items()}}
CLOSING = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}

MESSAGE = "struct<role string, text string>"
ROW = "struct<turn long, role string, text string>"
COUNTS = ("blank", "duplicate", "truncated")
SEGMENTS = (
    f"conv_id long, part int, seq long, kinds string, rows array<{ROW}>, weights array<binary>, blank long, "
    "duplicate long, truncated long, illegal long, turns long, first_turn long, last_turn long, "
    "first_initial string, last_initial string"
)
DECIDED = (
    "conv_id long, part int, seq long, entry int, audit string, at long, last boolean, gaps long, blank long, "
    "duplicate long, truncated long, illegal long, cost long"
)
REPORT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "n_messages long, repaired_sha256 string"
)


# ---------------------------------------------------------------- the graph


def edges(kind: str) -> dict[tuple[int, int], tuple[int, int]]:
    """The least (cost, field) from state to state across one row; ``kind`` is its role, or ``D``; upper case: truncated.

    ``kind``: "D" must be deleted; else the initial ("s", "u", "a" or "x" for any other), "S", "U", "A", "X" if truncated.
    """
    out: dict[tuple[int, int], tuple[int, int]] = {}
    for state in NEXT:
        at, inserted = state, ""
        for _ in range(3):
            ways = [(at, 3, "D")]
            if kind != "D":
                extra = int(kind.isupper())
                ways.append((NEXT[at], 2 + extra, "R"))
                if (at, kind.lower()) in KEPT:
                    ways.append((KEPT[at, kind.lower()], extra, "K"))
            for to, cost, letter in ways:
                field = 0
                for x in (inserted + letter).ljust(3):
                    field = 8 * field + LETTERS.index(x)
                way = (cost + 2 * len(inserted), field)
                out[state, to] = min(way, out.get((state, to), way))
            at, inserted = NEXT[at], inserted + "I"
    return out


GRAPH = {kind: edges(kind) for kind in "DsuaxSUAX"}


def weights(kinds: str, entries: tuple[int, ...], size: int) -> list[int | None]:
    """The least integer from each entry state to each state, row by row; None where there is no way."""
    low = FIELD * size
    out: list[int | None] = [None] * 16
    for entry in entries:
        best: dict[int, int] = {entry: 0}
        for i, kind in enumerate(kinds):
            shift = FIELD * (size - 1 - i)
            reached: dict[int, int] = {}
            for (state, to), (cost, field) in GRAPH[kind].items():
                if state in best:
                    weight = best[state] + (cost << low) + (field << shift)
                    if to not in reached or weight < reached[to]:
                        reached[to] = weight
            best = reached
        for to, weight in best.items():
            out[4 * entry + to] = weight
    return out


def fields(weight: int, count: int, size: int) -> list[str]:
    """The letters in the fields of the first ``count`` rows."""
    out = []
    for i in range(count):
        field = weight >> FIELD * (size - 1 - i)
        out.append("".join(LETTERS[field >> shift & 7] for shift in (6, 3, 0)).strip())
    return out


def way(segments: list[list[int | None]], size: int) -> tuple[int, list[int]]:
    """The cost of the cheapest edits, and the state before each segment and after the last.

    The letters of all earlier segments are replaced by their rank among the (at most four) states, which keeps
    every comparison and lets integers stay short.
    """
    low = FIELD * size
    best = {START: 0}
    back: list[dict[int, int]] = []
    for table in segments:
        reached: dict[int, tuple[int, int]] = {}
        for state, value in best.items():
            for to in NEXT:
                weight = table[4 * state + to]
                if weight is not None:
                    total = (value << low) + (weight >> low << low + 2) + (weight & (1 << low) - 1)
                    reached[to] = min((total, state), reached.get(to, (total, state)))
        letters = sorted(reached, key=lambda to: reached[to][0] & (1 << low + 2) - 1)
        best = {to: (reached[to][0] >> low + 2 << 2) + rank for rank, to in enumerate(letters)}
        back.append({to: state for to, (_, state) in reached.items()})
    end = min(best, key=lambda state: best[state] + (2 * CLOSING[state] << 2))
    cost = (best[end] >> 2) + 2 * CLOSING[end]
    states = [end]
    for came in reversed(back):
        states.append(came[states[-1]])
    return cost, states[::-1]


# ---------------------------------------------------------------- segments


def counted(rows: DataFrame) -> DataFrame:
    """Different rows with their number of copies and whether an earlier row has their role and text."""
    conv, turn = F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn")
    plain = rows.select(conv, turn, *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])
    different = plain.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    again = different.groupBy("conv_id", "role", "text").agg(F.min(order).alias("first"), F.count("*").alias("places"))
    again = again.where("places > 1").select(
        F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("text").alias("t"), "first"
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("text") == F.col("t"))
    seen = F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    return different.join(again, same, "left").select("conv_id", "turn", "role", "text", "copies", seen.alias("seen"))


def segments(rows: DataFrame, size: int = SEGMENT) -> DataFrame:
    """The segments of all conversations, in order of (``conv_id``, ``part``, ``seq``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        known = keep(("repair weights", size), dict)
        seq = 0
        done: list[tuple] = []
        rows: list[dict] = []
        kinds: list[str] = []
        faults = dict.fromkeys(COUNTS, 0)
        conv, open_conv, began, chars = None, False, True, 0

        def close(entries: tuple[int, ...]) -> None:
            nonlocal seq, rows, kinds, faults, chars
            key = (entries, "".join(kinds))
            table = known.get(key)
            if table is None:
                width = (FIELD * size + 7) // 8
                table = [
                    None if w is None else (w << -FIELD * size % 8).to_bytes(width + 8, "big").rstrip(b"\0")
                    for w in weights(key[1], entries, size)
                ]
                if len(known) < REMEMBERED and len(kinds) <= 16:
                    known[key] = table
            initials = [r["role"][:1] for r in rows]
            turns = [r["turn"] for r in rows if r["turn"] is not None]
            illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials[:-1], initials[1:], strict=True))
            span = (len(set(turns)), turns[0], turns[-1]) if turns else (0, None, None)
            counts = [faults[c] for c in COUNTS]
            done.append((conv, part, seq, key[1], rows, table, *counts, illegal, *span, initials[0], initials[-1]))
            seq, rows, kinds, faults, chars = seq + 1, [], [], dict.fromkeys(COUNTS, 0), 0

        def flush() -> pa.RecordBatch:
            nonlocal done
            out, done = done, []
            return table_of(out, SEGMENT_TYPES, SEGMENT_NAMES)

        held = 0
        for batch in slices(batches):
            for row in batch.to_pylist():
                if not open_conv or row["conv_id"] != conv:
                    if rows:
                        close((START,) if began else tuple(NEXT))
                    # Only the first conversation of a task can have begun in an earlier one.
                    began, conv, open_conv = open_conv or part == 0, row["conv_id"], True
                words = row["text"].strip(BLANKS)
                for copy in range(row["copies"]):
                    if len(rows) >= size or chars >= SEGMENT_CHARS:
                        close((START,) if began else tuple(NEXT))
                        began = False
                    kind = row["role"][:1] if row["role"][:1] in ("s", "u", "a") else "x"
                    if not words:
                        faults["blank"] += 1
                        kind = "D"
                    elif row["seen"] or copy:
                        faults["duplicate"] += 1
                        kind = "D"
                    elif words[-1] not in ".!?":
                        faults["truncated"] += 1
                        kind = kind.upper()
                    kinds.append(kind)
                    rows.append({"turn": row["turn"], "role": row["role"], "text": row["text"]})
                    chars += len(row["text"]) + len(row["role"])
                    held += len(row["text"]) + len(row["role"])
                    if done and (len(done) >= 1000 or held > 4 * SEGMENT_CHARS):
                        yield flush()
                        held = 0
        if rows:
            close((START,) if began else tuple(NEXT))
        if done:
            yield flush()

    beginnings = [F.substring(c, 1, 32).alias(f"{c}_begin") for c in ("role", "text")]
    dealt = counted(rows).select("*", *beginnings)
    order = ["conv_id", "turn", "role_begin", "text_begin"]
    dealt = dealt.repartitionByRange(*order).sortWithinPartitions(*order, "role", "text")
    return dealt.select("conv_id", "turn", "role", "text", "copies", "seen").mapInArrow(run, SEGMENTS)


ROW_TYPE = pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
SEGMENT_NAMES = [x.split(" ")[0] for x in SEGMENTS.replace(ROW, "row").split(", ")]
SEGMENT_TYPES = [
    pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.list_(ROW_TYPE), pa.list_(pa.binary()), *[pa.int64()] * 7,
    pa.string(), pa.string(),
]
DECIDED_NAMES = [x.split(" ")[0] for x in DECIDED.split(", ")]
DECIDED_TYPES = [
    pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.bool_(), *[pa.int64()] * 6
]
REPORT_NAMES = [x.split(" ")[0] for x in REPORT.split(", ")]
REPORT_TYPES = [*[pa.int64()] * 7, pa.string(), pa.int64(), pa.string()]


def in_order(df: DataFrame) -> DataFrame:
    """Segments of a conversation one after the other, in one partition."""
    return df.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")


def decide(cut: DataFrame, size: int = SEGMENT) -> DataFrame:
    """For each segment its entry state, letters and place of its first message; at the last one the whole's figures."""

    def whole(parts: list[dict]) -> list[tuple]:
        width = (FIELD * size + 7) // 8
        tables = [
            [None if w is None else int.from_bytes(w.ljust(width + 8, b"\0"), "big") >> -FIELD * size % 8 for w in p["weights"]]
            for p in parts
        ]
        cost, states = way(tables, size)
        out, at = [], 0
        for i, part in enumerate(parts):
            weight = tables[i][4 * states[i] + states[i + 1]]
            audit = "".join(fields(weight, len(part["kinds"]), size))
            if i == len(parts) - 1:
                audit += "I" * CLOSING[states[-1]]
            out.append([part["conv_id"], part["part"], part["seq"], states[i], audit, at, False, *[None] * 6])
            at += len(audit) - audit.count("D")
        turns, before = 0, None
        for part in parts:
            if part["first_turn"] is not None:
                turns += part["turns"] - (part["first_turn"] == before)
                before = part["last_turn"]
        first = next((p["first_turn"] for p in parts if p["first_turn"] is not None), None)
        gaps = 0 if first is None else before - first + 1 - turns
        joints = [a["last_initial"] + b["first_initial"] for a, b in zip(parts[:-1], parts[1:], strict=True)]
        illegal = sum(p["illegal"] for p in parts) + sum(x not in ("su", "ua", "au") for x in joints)
        out[-1][6:] = [True, gaps, *(sum(p[c] for p in parts) for c in COUNTS), illegal, cost]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                if held and held[0]["conv_id"] != row["conv_id"]:
                    out += whole(held)
                    held = []
                held.append(row)
            if out:
                yield table_of(out, DECIDED_TYPES, DECIDED_NAMES)
        if held:
            yield table_of(whole(held), DECIDED_TYPES, DECIDED_NAMES)

    return in_order(cut.drop("rows")).mapInArrow(run, DECIDED)


def table_of(rows: list, types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def edited(rows: list[dict], state: int, audit: str) -> list[dict]:
    """The messages that the letters make of the rows."""
    out = []
    source = iter(rows)
    for letter in audit:
        if letter == "I":
            state = NEXT[state]
            out.append({"role": "assistant" if state == ASSISTANT else "user", "text": ""})
            continue
        row = next(source)
        if letter == "R":
            state = NEXT[state]
            out.append({"role": "assistant" if state == ASSISTANT else "user", "text": row["text"]})
        elif letter == "K":
            state = KEPT[state, row["role"][:1]]
            out.append({"role": row["role"], "text": row["text"]})
    return out


def apply(cut: DataFrame, decided: DataFrame) -> DataFrame:
    """The segments with their repaired ``messages``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
        for batch in batches:
            for at in range(0, batch.num_rows, 16):
                some = batch.slice(at, 16)
                values = [some.column(c).to_pylist() for c in ("rows", "entry", "audit")]
                made = pa.array([edited(*x) for x in zip(*values, strict=True)], kind)
                columns = [some.column(c) for c in DECIDED_NAMES]
                yield pa.RecordBatch.from_arrays([*columns, made], [*DECIDED_NAMES, "messages"])

    found = cut.select("part", "seq", "rows").join(decided, ["part", "seq"])
    return found.select("rows", *DECIDED_NAMES).mapInArrow(run, f"{DECIDED}, messages array<{MESSAGE}>")


class Repair(NamedTuple):
    """``segments``: the repaired segments, written; the other tables are views of them."""

    segments: DataFrame

    def messages(self) -> DataFrame:
        """``conv_id, position, role, text`` of the repaired conversations."""
        spread = self.segments.select("conv_id", "at", F.posexplode("messages").alias("i", "m"))
        return spread.select("conv_id", (F.col("at") + F.col("i")).alias("position"), "m.role", "m.text")

    def reports(self) -> DataFrame:
        """One row for each conversation: its faults, the cost and letters of its edits, and a digest of the result.

        A digest needs the lines of a conversation one after the other; they pass one task as a stream.
        """

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            digest, audit, lines = hashlib.sha256(), [], 0
            for batch in batches:
                out = []
                for row in batch.to_pylist():
                    for message in row["messages"]:
                        text = f"{message['role']}:{message['text']}"
                        digest.update((("\n" if lines else "") + text).encode())
                        lines += 1
                    audit.append(row["audit"])
                    if row["last"]:
                        figures = [row[c] for c in ("gaps", *COUNTS, "illegal", "cost")]
                        out.append((row["conv_id"], *figures, "".join(audit), lines, digest.hexdigest()))
                        digest, audit, lines = hashlib.sha256(), [], 0
                if out:
                    yield table_of(out, REPORT_TYPES, REPORT_NAMES)

        return in_order(self.segments).mapInArrow(run, REPORT)


def repair(rows: DataFrame, size: int = SEGMENT) -> Repair:
    """Repair the conversations of ``rows`` (``conv_id``, ``turn``, ``role``, ``text``)."""
    cut = files.materialize(segments(rows, size), "segments")
    decided = decide(cut, size)
    return Repair(files.materialize(apply(cut, decided), "repaired"))
