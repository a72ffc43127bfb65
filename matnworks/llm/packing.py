"""Best-fit packing by linear grouping.

Every document becomes token ids plus an end id; longer ones are cut. How many pieces of each length there
are is a table of at most ``CAPACITY`` rows, whatever the corpus, and the plan is made on it: large lengths
are rounded up to the largest of groups of equal cardinality, the few sizes left are combined by the
configuration program (columns priced by a knapsack), actual lengths take the slots of their group, and
small lengths go best-fit into what stays free. The plan is a list of runs "ranks r to r+m of length l go to
sequences s to s+m at offset o"; pieces learn their rank by prefix sums over partitions, so no key is hot.

Null text: an empty document, one end id. Empty tables give no rows. Repeated rows are packed once each.
Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matnworks.llm.words import slices
from matnworks.llm.worker import keep
from matnworks.sources import files

CAPACITY = 1024
END_ID = 2
LARGE = (CAPACITY // 4, CAPACITY // 3, CAPACITY // 2)
GROUPS = 64
CACHED_WORDS = 400_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, slot long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
PIECE_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "slot"]
PIECE_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
PACKED_NAMES = [*PIECE_NAMES[:5], "sequence_id", "offset"]


# ---------------------------------------------------------------- tokens


class Encoder:
    """Token ids of texts as little-endian bytes, equal to ``Tokenizer.encode(text, add_special_tokens=False)``.

    In the byte-level vocabulary a blank before a non-blank always begins a token, so the ids of a text are
    those of its blank-separated chunks, and the ids of a chunk can be kept; at most ``CACHED_WORDS`` are.
    New chunks are encoded together, joined by the zero byte, which no longer token contains. Texts with
    a blank beside other white space, or with a zero byte, are encoded whole. The same vocabulary as ranks
    serves for all of these, at a quarter of the time; texts with a special string go to the tokenizer itself.
    """

    def __init__(self, tokenizer: str, ranks: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        if [token for token in table if b"\0" in token] != [b"\0"]:
            raise ValueError("the zero byte must be a token of its own only")
        self.zero = table[b"\0"]
        self.plain = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.tokenizer = Tokenizer.from_file(tokenizer)
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = re.compile(r" \s|\s \Z|\0")
        self.known: dict[str, bytes] = {}

    def _ids(self, text: str) -> bytes:
        return array("I", self.plain.encode_ordinary(text)).tobytes()

    def _learn(self, words: list[str]) -> None:
        data = self._ids("\0".join([f" {word}" for word in words]))
        cuts = np.flatnonzero(np.frombuffer(data, "<u4") == self.zero) * 4
        begin, end = [0, *(cuts + 4).tolist()], [*cuts.tolist(), len(data)]
        self.known.update(zip(words, (data[i:j] for i, j in zip(begin, end, strict=True)), strict=True))

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        if len(self.known) > CACHED_WORDS:
            self.known = {}
        known = self.known
        special = [any(s in text for s in self.special) for text in texts]
        cut = [None if x or self.odd.search(text) else text.split(" ") for text, x in zip(texts, special, strict=True)]
        new = list({word for words in cut if words for word in words[1:] if word not in known})
        if new:
            self._learn(new)
        for text, words, x in zip(texts, cut, special, strict=True):
            if words:
                yield self._ids(words[0]) + b"".join(map(known.__getitem__, words[1:]))
            elif x:
                yield array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
            else:
                yield self._ids(text)


def pieces(docs: DataFrame, tokenizer: str, ranks: str, pattern: str) -> DataFrame:
    """Pieces of at most ``CAPACITY`` tokens, each with the task that made it and its place there among its length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = keep((Encoder.__name__, tokenizer, ranks, pattern), lambda: Encoder(tokenizer, ranks, pattern))
        part = TaskContext.get().partitionId()
        seen = [0] * (CAPACITY + 1)
        last = np.array([END_ID], "<u4").tobytes()
        for batch in slices(batches):
            out: list[tuple] = []
            texts = batch.column(1).fill_null("").to_pylist()
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(texts), strict=True):
                data = ids + last
                size = len(data) // 4
                start, to = 0, (size - 1) % CAPACITY + 1
                piece = 0
                while start < size:
                    length = to - start
                    out.append((doc_id, piece, start, length, zlib.crc32(data[4 * start : 4 * to]), part, seen[length]))
                    seen[length] += 1
                    start, to, piece = to, to + CAPACITY, piece + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), PIECE_TYPES, strict=True)], PIECE_NAMES
            )

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


# ---------------------------------------------------------------- the plan


def configurations(sizes: np.ndarray, demand: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """Patterns of sizes within the capacity and how often to use each: the configuration program, rounded down.

    Revised simplex; a column enters when a knapsack over the dual prices finds one worth more than a sequence.
    """
    k = len(sizes)
    small = np.searchsorted(sizes, np.arange(CAPACITY + 1), "right")
    columns = np.diag(CAPACITY // sizes).astype(float)
    inverse = np.diag(1.0 / np.diag(columns))
    amount = inverse @ demand
    for _ in range(40 * k):
        price = inverse.sum(axis=0)
        best, choice = np.zeros(CAPACITY + 1), np.full(CAPACITY + 1, -1)
        for room in range(int(sizes.min()), CAPACITY + 1):
            fit = best[room - sizes[: small[room]]] + price[: small[room]]
            top = int(fit.argmax())
            best[room] = best[room - 1]
            if fit[top] > best[room] + 1e-12:
                best[room], choice[room] = fit[top], top
        if best[CAPACITY] <= 1 + 1e-4:
            break
        column, room = np.zeros(k), CAPACITY
        while room > 0:
            if choice[room] < 0:
                room -= 1
            else:
                column[choice[room]] += 1
                room -= sizes[choice[room]]
        step = inverse @ column
        ratio = np.full(k, np.inf)
        np.divide(amount, step, out=ratio, where=step > 1e-9)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        amount -= ratio[out] * step
        amount[out] = ratio[out]
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
        columns[:, out] = column
    return [(columns[:, i].astype(int), int(amount[i] + 1e-6)) for i in range(k) if amount[i] >= 1 - 1e-6]


class Plan:
    """Runs of equal sequences, built from the number of pieces of each length."""

    def __init__(self, histogram: dict[int, int], large: int):
        self.large = large
        self.left = dict(histogram)
        self.taken: dict[int, int] = defaultdict(int)
        self.runs: list[tuple[int, int, int, int, int]] = []
        self.sequences = 0
        self.open: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self._large()
        for length in sorted(self.left, reverse=True):
            self._best_fit(length)

    def _place(self, length: int, each: int, count: int, sequence: int, used: int) -> None:
        """``count`` pieces, ``each`` per sequence, from ``sequence`` on, behind ``used`` tokens."""
        self.runs.append((length, self.taken[length], each, sequence, used))
        self.taken[length] += count
        self.left[length] -= count

    def _close(self, sequence: int, count: int, used: int) -> None:
        if count and used < CAPACITY:
            self.open[CAPACITY - used].append((sequence, count))

    def _large(self) -> None:
        """Linear grouping: groups of equal cardinality, each rounded up to its largest length."""
        queue = [(n, c) for n, c in sorted(self.left.items(), reverse=True) if self.large < n < CAPACITY and c]
        total = sum(c for _, c in queue)
        share = -(-total // GROUPS)
        groups: list[list[list[int]]] = []
        room = 0
        for length, count in queue:
            while count:
                if not room:
                    groups.append([])
                    room = share
                part = min(count, room)
                groups[-1].append([length, part])
                count, room = count - part, room - part
        if not groups:
            return
        sizes = np.array([g[0][0] for g in groups])
        distinct = np.unique(sizes)
        demand = np.array([sum(c for g, s in zip(groups, sizes, strict=True) if s == d for _, c in g) for d in distinct])
        stock = {int(d): [e for g, s in zip(groups, sizes, strict=True) if s == d for e in g] for d in distinct}
        for pattern, times in configurations(distinct, demand):
            pattern[np.flatnonzero(pattern)[0]] -= 1  # its smallest slot is left to best-fit, which knows actual lengths
            slots = [(stock[int(s)], int(a)) for s, a in zip(distinct, pattern, strict=True) if a][::-1]
            while times:
                slots = [(items, a) for items, a in slots if items]
                if not slots:
                    break
                span = min(times, *(max(1, items[0][1] // a) for items, a in slots))
                used = 0
                for items, a in slots:
                    while a and items:
                        each = min(a, items[0][1]) if span == 1 else a
                        length = items[0][0]
                        self._place(length, each, each * span, self.sequences, used)
                        used += each * length
                        items[0][1] -= each * span
                        if not items[0][1]:
                            items.pop(0)
                        a -= each
                self._close(self.sequences, span, used)
                self.sequences += span
                times -= span

    def _best_fit(self, length: int) -> None:
        """Each piece goes where least room stays; equal pieces and equal sequences are handled together."""
        while count := self.left[length]:
            room = min((r for r, runs in self.open.items() if r >= length and runs), default=0)
            if room:
                sequence, width = self.open[room].pop()
            else:
                room, sequence, width = CAPACITY, self.sequences, -(-count // (CAPACITY // length))
                self.sequences += width
            each, used = room // length, CAPACITY - room
            full = min(width, count // each)
            if full:
                self._place(length, each, full * each, sequence, used)
                self._close(sequence, full, used + each * length)
            if full < width:
                rest = min(count - full * each, each)
                if rest:
                    self._place(length, rest, rest, sequence + full, used)
                    self._close(sequence + full, 1, used + rest * length)
                self._close(sequence + full + bool(rest), width - full - bool(rest), used)


def best_plan(histogram: dict[int, int]) -> Plan:
    """The plan with the fewest sequences over the lengths from which a piece may count as large."""
    return min((Plan(histogram, large) for large in LARGE), key=lambda plan: plan.sequences)


# ---------------------------------------------------------------- the operator


def pack(docs: DataFrame, tokenizer: str, ranks: str, pattern: str) -> DataFrame:
    """One row per piece of ``docs`` (``doc_id``, ``text``) with its sequence and its offset there."""
    cut = files.materialize(pieces(docs, tokenizer, ranks, pattern), "pieces")
    counts = cut.groupBy("length", "part").agg(F.count("*").alias("pieces"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "part", F.coalesce(F.sum("pieces").over(before), F.lit(0)).alias("base"))
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = np.array(sorted(best_plan(histogram).runs), np.int64).reshape(-1, 5)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = (runs[:, 0] << 48) + runs[:, 1]
        for batch in batches:
            length, rank = (np.asarray(batch.column(c)) for c in ("length", "rank"))
            run = runs[np.searchsorted(starts, (length << 48) + rank, "right") - 1]
            place = rank - run[:, 1]
            columns = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            columns += [pa.array(run[:, 3] + place // run[:, 2]), pa.array(run[:, 4] + place % run[:, 2] * length)]
            yield pa.RecordBatch.from_arrays(columns, PACKED_NAMES)

    ranked = cut.join(base, ["length", "part"]).withColumn("rank", F.col("base") + F.col("slot"))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(assign, PACKED)
