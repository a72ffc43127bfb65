"""Chat formatting by schema fingerprints.

A record is a JSON object of any layout. The hash of its nested field paths, as far as any mapping declares
them, selects a declarative mapping, which names the fields that become canonical turns. Other fields of a record
(ids, scores, sources) do not matter. A template writes turns as one text, marks the spans that count for the
loss, and escapes its own control strings inside roles and texts by a backslash behind their first character;
taking one backslash away restores them.

Every record gives one row. Unknown records have null turns and the fingerprint of all their paths, so that a
mapping can be added: null, no JSON object, too deep for the parser, paths of no mapping or of several, a list with
elements that are no objects, or a text that is an object or a list. An empty or null list has no turns. A required
field that is null is an empty turn; an optional one that is null or empty is no turn. Numbers and truth values are
texts as JSON writes them. A surrogate without its other half becomes U+FFFD.

A conversation may hold any share of the rows. It is cut into parts, which end at ``SEGMENT`` rows or with the row that
reaches ``SEGMENT_BYTES`` of text, each a record of its own; the formatted texts of its parts, in order, are the formatted
conversation. Rows reach parts by ranges of (conversation, turn, role, beginning of the text), so the parts of one
conversation are written and formatted by different tasks, and no task holds a conversation.

Null text or role: empty. A null ``conv_id`` is a conversation of its own. Empty tables give no rows. Repeated rows are
formatted one by one; in ``records`` rows of one turn number stand in the order of role and text, null turns first.
Other columns than those named are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matnworks.llm.words import slices

SEGMENT = 256
SEGMENT_BYTES = 1 << 20

PARTS = "conv_id long, part long, turns array<struct<turn: long, role: string, text: string>>"
FORMATTED = (
    "conv_id long, part long, fingerprint string, layout string, turns array<struct<role: string, text: string>>, "
    "formatted string, loss array<struct<start: int, end: int>>"
)
TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


@dataclass(frozen=True)
class Mapping:
    """A layout: either single fields, each a turn of a fixed role, or a list of messages.

    ``fields`` are (path, role); ``messages`` is the list, with ``role`` and ``text`` inside it. ``optional``
    paths may be absent. ``names`` translates roles.
    """

    layout: str
    fields: tuple[tuple[str, str], ...] = ()
    messages: str = ""
    role: str = ""
    text: str = ""
    optional: tuple[str, ...] = ()
    names: tuple[tuple[str, str], ...] = ()

    def paths(self) -> list[str]:
        return [p for p, _ in self.fields] + ([self.messages, *self.inner()] if self.messages else [])

    def inner(self) -> list[str]:
        return [f"{self.messages}[].{self.role}", f"{self.messages}[].{self.text}"]

    def fingerprints(self) -> Iterator[str]:
        loose = [*self.optional, *(self.inner() if self.messages else [])]  # an empty list has no paths inside it
        fixed = [p for p in self.paths() if p not in loose]
        for n in range(len(loose) + 1):
            for some in itertools.combinations(loose, n):
                yield fingerprint_of({*fixed, *some})

    def turns(self, record: dict) -> list[tuple[str, str]] | None:
        """The turns, or None where a value is of another type than this layout has."""
        found = [(role, record.get(path)) for path, role in self.fields if path not in self.optional or record.get(path) not in (None, "")]
        if self.messages:
            listed = record.get(self.messages)
            listed = [] if listed is None else listed
            if not isinstance(listed, list) or not all(isinstance(m, dict) for m in listed):
                return None
            found += [(m.get(self.role), m.get(self.text)) for m in listed]
        if any(isinstance(x, (dict, list)) for turn in found for x in turn):
            return None
        names = dict(self.names)
        shown = [(plain_text(role), plain_text(text)) for role, text in found]
        return [(names.get(role, role), text) for role, text in shown]


def plain_text(value: object) -> str:
    """A JSON scalar as text that can be stored."""
    text = value if isinstance(value, str) else "" if value is None else json.dumps(value)
    try:
        text.encode()
    except UnicodeEncodeError:
        return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
    return text


MAPPINGS = (
    Mapping("prompt", fields=(("system", "system"), ("prompt", "user"), ("completion", "assistant")), optional=("system",)),
    Mapping("question", fields=(("question", "user"), ("answer", "assistant"))),
    Mapping(
        "instruction",
        fields=(("system", "system"), ("instruction", "user"), ("input", "user"), ("output", "assistant")),
        optional=("system", "input"),
    ),
    Mapping("messages", messages="messages", role="role", text="content", fields=(("system", "system"),), optional=("system",)),
    Mapping("turns", messages="turns", role="role", text="text"),
    Mapping(
        "from_value",
        messages="conversations",
        role="from",
        text="value",
        fields=(("system", "system"),),
        optional=("system",),
        names=(("human", "user"), ("gpt", "assistant")),
    ),
)


def field_paths(value: object, prefix: str = "") -> Iterator[str]:
    """Paths of all fields below ``value``; list elements share one path."""
    pending = [(value, prefix)]
    while pending:
        value, prefix = pending.pop()
        if isinstance(value, dict):
            for key, inner in value.items():
                path = f"{prefix}.{key}" if prefix else key
                yield path
                pending.append((inner, path))
        elif isinstance(value, list):
            pending.extend((inner, f"{prefix}[]") for inner in value)


def fingerprint_of(paths: set[str]) -> str:
    return hashlib.blake2b("\n".join(sorted(paths)).encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


# ---------------------------------------------------------------- the template

BEGIN, END, OPEN, CLOSE = "<s>", "</s>", "[INST]", "[/INST]"
_controls = "|".join(rf"{re.escape(c[0])}(?P<x{i}>\\*){re.escape(c[1:])}" for i, c in enumerate((BEGIN, END, OPEN, CLOSE)))
ESCAPE = re.compile(rf"(?:{_controls})")
TURN = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", re.DOTALL)


def escape(text: str) -> str:
    return ESCAPE.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return ESCAPE.sub(lambda m: m[0][0] + m[0][2:] if m[0][1] == "\\" else m[0], text)


def write(turns: list[tuple[str, str]], loss_role: str) -> tuple[str, list[dict]]:
    """The formatted text, and the spans of it that count for the loss."""
    parts, spans, size = [], [], 0
    for role, text in turns:
        head, body = f"{BEGIN}{OPEN}{escape(role)}{CLOSE}", escape(text)
        start = size + len(head)
        if role == loss_role:
            spans.append({"start": start, "end": start + len(body)})
        parts += [head, body, END]
        size = start + len(body) + len(END)
    return "".join(parts), spans


def read(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text."""
    return [(unescape(role), unescape(text)) for role, text in TURN.findall(formatted)]


# ---------------------------------------------------------------- the operator


def parts(rows: DataFrame, size: int = SEGMENT) -> DataFrame:
    """``conv_id, part, turns``: the rows of each conversation in order, cut into parts that one task can hold."""

    def starts(batch: pa.RecordBatch) -> list[int]:
        out, count, chars, before = [], 0, 0, None
        sizes = pc.binary_length(batch.column(3)).to_pylist()
        for i, (conv_id, length) in enumerate(zip(batch.column(0).to_pylist(), sizes, strict=True)):
            if not out or conv_id != before or count >= size or chars >= SEGMENT_BYTES:
                out.append(i)
                count = chars = 0
            count, chars, before = count + 1, chars + length, conv_id
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        rest = None

        def cut(batch: pa.RecordBatch, bounds: list[int]) -> pa.RecordBatch:
            nonlocal number
            turns = pa.StructArray.from_arrays(batch.columns[1:], ["turn", "role", "text"])
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), turns)
            marks = pa.array(np.arange(number, number + len(lists)))
            number += len(lists)
            return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(bounds[:-1])), marks, lists], ["conv_id", "part", "turns"])

        for batch in slices(batches):
            batch = batch if rest is None else pa.concat_batches([rest, batch])
            bounds = starts(batch)
            rest = batch.slice(bounds[-1])  # the last part may go on in the next batch
            if len(bounds) > 1:
                yield cut(batch.slice(0, bounds[-1]), bounds)
        if rest is not None:
            yield cut(rest, [0, rest.num_rows])

    shown = [F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")]
    said = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *shown)
    order = ["conv_id", "turn", "role"]
    dealt = said.withColumn("begin", F.substring("text", 1, 32)).repartitionByRange(*order, "begin")
    return dealt.sortWithinPartitions(*order, "text").drop("begin").mapInArrow(run, PARTS)


def records(rows: DataFrame, layouts: tuple[Mapping, ...] | None = None, size: int = SEGMENT) -> DataFrame:
    """``conv_id, part, record``: the rows of each conversation (``conv_id, turn, role, text``) as JSON objects.

    A conversation has one record, or one for each ``part`` of a long one or of one on the edge of a range; parts
    are ordered by their number. ``layouts`` are the layouts to write, dealt by a hash of ``conv_id`` among those that
    can hold the part: layouts of single fields hold a user and an assistant row; lists hold any rows whose roles they
    do not rename, so at least one of ``layouts`` must be a list without ``names``. By default all rows are written
    as ``turns``.
    """
    layouts = layouts or tuple(m for m in MAPPINGS if m.layout == "turns")
    roles = F.col("turns.role")
    pair = (F.size("turns") == 2) & (roles[0] == "user") & (roles[1] == "assistant")
    deal = F.xxhash64(F.col("conv_id"), F.lit("layout"))

    def written(layout: Mapping) -> Column:
        if layout.messages:
            role = lambda t: functools.reduce(lambda c, n: F.when(t["role"] == n[1], n[0]).otherwise(c), layout.names, t["role"])
            inside = F.transform("turns", lambda t: F.struct(role(t).alias(layout.role), t["text"].alias(layout.text)))
            return F.to_json(F.struct(F.col("conv_id").alias("id"), inside.alias(layout.messages)))
        paths = {role: path for path, role in layout.fields if path not in layout.optional}
        said = [F.col("turns.text")[i].alias(paths[role]) for i, role in enumerate(("user", "assistant"))]
        return F.to_json(F.struct(F.col("conv_id").alias("id"), *said))

    def dealt(choice: list[Mapping]) -> Column:
        out = written(choice[-1])
        for i, layout in enumerate(choice[:-1]):
            out = F.when(F.pmod(deal, F.lit(len(choice))) == i, written(layout)).otherwise(out)
        return out

    renamed = F.array(*[F.lit(n) for m in layouts for n, _ in m.names]) if any(m.names for m in layouts) else None
    plain = [m for m in layouts if m.messages and not m.names]
    lists = [m for m in layouts if m.messages]
    record = dealt(plain) if renamed is None else F.when(F.arrays_overlap(roles, renamed), dealt(plain)).otherwise(dealt(lists))
    if len(lists) < len(layouts):
        record = F.when(pair, dealt(list(layouts))).otherwise(record)
    return parts(rows, size).select("conv_id", "part", record.alias("record"))


def format_chat(df: DataFrame, mappings: tuple[Mapping, ...] = MAPPINGS, loss_role: str = "assistant") -> DataFrame:
    """Canonical turns, the formatted text and its loss spans of every ``conv_id, part, record``.

    Without a column ``part`` each record is a conversation.
    """
    known = {mark: m for m in mappings for mark in m.fingerprints()}
    declared = {path for m in mappings for path in m.paths()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "record"):
            out: list[tuple] = []
            for conv_id, part, record in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                try:
                    value = json.loads(record) if record is not None else None
                except (ValueError, RecursionError):
                    value = None
                paths = set(field_paths(value))
                mark = fingerprint_of(paths & declared)
                mapping = known.get(mark) if isinstance(value, dict) else None
                turns = mapping.turns(value) if mapping else None
                if turns is None:
                    out.append((conv_id, part, fingerprint_of(paths), None, None, None, None))
                    continue
                formatted, loss = write(turns, loss_role)
                out.append((conv_id, part, mark, mapping.layout, [{"role": r, "text": t} for r, t in turns], formatted, loss))
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), TURNS, pa.string(), SPANS]
            names = ["conv_id", "part", "fingerprint", "layout", "turns", "formatted", "loss"]
            columns = zip(*out, strict=True) if out else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    part = F.col("part") if "part" in df.columns else F.lit(0).cast("long").alias("part")
    return df.select("conv_id", part, "record").mapInArrow(run, FORMATTED)


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


class Reading:
    """Digests of a conversation, read part by part."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.part, self.known = conv_id, -1, True
        self.turns = self.loss = self.size = 0
        self.turns_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def add(self, part: int, text: str | None, spans: list[dict] | None) -> None:
        self.part = part
        if text is None:
            self.known = False
            return
        turns = read(text)
        loss = "".join([unescape(text[s["start"] : s["end"]]) for s in spans])
        self.turns_hash.update("".join([f"{role}\n{body}\n" for role, body in turns]).encode())
        self.loss_hash.update(loss.encode())
        self.turns, self.loss, self.size = self.turns + len(turns), self.loss + len(loss), self.size + len(text)

    def row(self) -> tuple:
        if not self.known:
            return (self.conv_id, None, None, None, None, None)
        return (self.conv_id, self.turns, self.turns_hash.hexdigest(), self.loss, self.loss_hash.hexdigest(), self.size)


def read_back(formatted: DataFrame) -> DataFrame:
    """What a reader gets from ``formatted`` and ``loss`` alone: turns and loss text, as digests; nulls for unknown
    records, also where one part of a conversation is unknown.

    A digest needs the parts of a conversation one after the other; they pass one task as a stream. A row whose
    ``part`` is not behind that of the row before is a record of its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

        def table(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

        reading = None
        for batch in slices(batches, "formatted"):
            out: list[tuple] = []
            for conv_id, part, text, spans in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if reading is None or conv_id != reading.conv_id or part <= reading.part:
                    if reading is not None:
                        out.append(reading.row())
                    reading = Reading(conv_id)
                reading.add(part, text, spans)
            if out:
                yield table(out)
        if reading is not None:
            yield table([reading.row()])

    ordered = formatted.select("conv_id", "part", "formatted", "loss").repartition("conv_id")
    return ordered.sortWithinPartitions("conv_id", "part").mapInArrow(run, DIGESTS)
