"""Substring deduplication with automata of repeated phrases.

A window is ``WINDOW`` consecutive words. The smallest hash among the short grams of a window is its anchor;
it depends on the window's content alone, so equal windows of any documents have equal anchors.
Neighbouring windows with one anchor form a phrase. Phrases whose anchor occurs in several documents are
confirmed: their text is read from the first document that has them, and for each of their windows the first
document is determined among all phrases of the anchor. Documents are then dealt into blocks, every block
receives the phrases that may occur in it, compiles them into Aho-Corasick automata of bounded size, and
streams its documents through them. A located phrase removes the words of those of its windows that start
in an earlier document. The automata compare words; which windows of one anchor are equal is told by 64-bit hashes.

An anchor, a phrase or a group of copies may hold any share of the documents: they are combined before each
shuffle, and a block receives a phrase once.

Null text: no words. Empty tables give no rows. Rows with one ``doc_id`` are one document: no text of it is earlier
than another. A row without id is behind all ids: it loses what occurs in a document that has one, and no other
row loses anything to it. Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matnworks.llm.words import Texts, rolling, slices, sliding_minimum, spans
from matnworks.sources import files

WINDOW = 50
GRAM = 10
SHARD_WORDS = 400_000
BLOCK_BYTES = 8 << 20
ALPHABET = [chr(code) for code in range(48, 112)]

ANCHORS = "doc_id long, block int, anchor long, phrase long, at int, windows int"
PHRASES = "anchor long, phrase long, first long, windows int, several boolean, text binary, hashes array<long>"
KEPT = "doc_id long, n_words long, n_removed long, kept_text string, removed array<struct<start: int, end: int>>"
SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def anchors(docs: DataFrame) -> DataFrame:
    """The phrases of every document: anchor, hash of the phrase, first window and number of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = Texts(batch.column(1))
            words = texts.word_hashes()
            least = sliding_minimum(rolling(words, GRAM), WINDOW - GRAM + 1)
            valid = texts.windows(WINDOW)[: len(least)]
            rows = texts.word_rows()[: len(least)]
            new = valid.copy()
            new[1:] &= (least[1:] != least[:-1]) | (rows[1:] != rows[:-1]) | ~valid[:-1]
            start = np.flatnonzero(new)
            stop = np.concatenate([start[1:], [len(least)]])
            count = np.add.reduceat(valid, start) if len(start) else stop[:0]
            of = rows[start]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(of)),
                    batch.column(2).take(pa.array(of)),
                    pa.array(least[start].view(np.int64)),
                    pa.array(spans(words, start, start + count + WINDOW - 1).view(np.int64)),
                    pa.array(start - texts.first[of], pa.int32()),
                    pa.array(count, pa.int32()),
                ],
                ["doc_id", "block", "anchor", "phrase", "at", "windows"],
            )

    return docs.select("doc_id", "text", "block").mapInArrow(run, ANCHORS)


def phrase_texts(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """Words of confirmed phrases, from ``firsts`` (``first, anchor, phrase, at, windows, several``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: list[tuple] = []
            texts = Texts(batch.column(1))
            values = texts.word_hashes()
            hashes = rolling(values, WINDOW).view(np.int64)
            for row, (doc_id, marks) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                words, base = texts.raw(row).split(), texts.first[row]
                ends = [base + m["at"] + m["windows"] + WINDOW - 1 for m in marks]
                fits = [m for m, end in zip(marks, ends, strict=True) if end <= texts.first[row + 1]]
                begins = base + np.array([m["at"] for m in fits], np.int64)
                own = spans(values, begins, begins + [m["windows"] + WINDOW - 1 for m in fits]) if fits else []
                for m, value in zip(fits, np.asarray(own, np.uint64).view(np.int64).tolist(), strict=True):
                    if value != m["phrase"]:
                        continue  # another text of the same id
                    at, n = m["at"], m["windows"]
                    text = b" ".join(words[at : at + n + WINDOW - 1])
                    own = hashes[base + at : base + at + n].tolist() if m["several"] else None
                    out.append((m["anchor"], m["phrase"], doc_id, n, m["several"], text, own))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.list_(pa.int64())]
            names = ["anchor", "phrase", "first", "windows", "several", "text", "hashes"]
            columns = zip(*out, strict=True) if out else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    marks = firsts.groupBy("first").agg(F.collect_list(F.struct("anchor", "phrase", "at", "windows", "several")).alias("marks"))
    texts = docs.select("doc_id", "text").join(marks.withColumnRenamed("first", "doc_id"), "doc_id")
    return texts.mapInArrow(run, PHRASES)


class Automaton:
    """Phrases of words, each word written with a few letters, so that nodes have few children."""

    def __init__(self, phrases: list[tuple[list[bytes], int, list[tuple[int, int]]]]):
        import ahocorasick

        vocabulary = dict.fromkeys(word for words, _, _ in phrases for word in words)
        self.width = 1
        while len(ALPHABET) ** self.width < len(vocabulary):
            self.width += 1
        for number, word in enumerate(vocabulary):
            vocabulary[word] = "".join(ALPHABET[number >> 6 * i & 63] for i in range(self.width))
        self.codes = vocabulary
        self.machine = ahocorasick.Automaton()
        for words, first, earlier in phrases:
            self.machine.add_word("".join([self.codes[word] for word in words]), (len(words), first, earlier))
        self.machine.make_automaton()

    def occurrences(self, words: list[bytes]) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
        """Start, first document and earlier windows of every phrase in ``words``.

        Only runs of known words that are long enough for a window can hold a phrase.
        """
        codes = list(map(self.codes.get, words))
        known = np.concatenate([[False], np.fromiter((c is not None for c in codes), bool, len(codes)), [False]])
        edges = np.flatnonzero(known[1:] != known[:-1])
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if b - a >= WINDOW:
                for last, (length, first, earlier) in self.machine.iter("".join(codes[a:b])):
                    if (last + 1) % self.width == 0:
                        yield a + (last + 1) // self.width - length, length, first, earlier


def automata(phrases: pa.Table) -> Iterator[Automaton]:
    """Shards of at most ``SHARD_WORDS`` words, or one phrase, one after the other."""
    shard, size = [], 0
    for batch in phrases.to_batches():
        texts, firsts, earlier = (batch.column(batch.schema.get_field_index(c)) for c in ("text", "first", "earlier"))
        for text, first, marks in zip(texts.to_pylist(), firsts.to_pylist(), earlier.to_pylist(), strict=True):
            words = text.split(b" ")
            if shard and size + len(words) > SHARD_WORDS:
                yield Automaton(shard)
                shard, size = [], 0
            shard.append((words, first, [(m["at"], m["first"]) for m in marks or ()]))
            size += len(words)
    if shard:
        yield Automaton(shard)


def locate(docs: pa.Table, phrases: pa.Table) -> pa.Table:
    """Remove from each document of a block the windows that start in an earlier document."""
    ids, texts = docs.column("doc_id").to_pylist(), docs.column("text")
    order = [2**64 if i is None else i for i in ids]
    cover: dict[int, np.ndarray] = {}
    for machine in automata(phrases):
        for row, text in enumerate(texts):
            words = (text.as_py() or "").encode().split()
            if len(words) < WINDOW:
                continue
            for start, length, first, earlier in machine.occurrences(words):
                if first < order[row]:
                    ranges = [(start, start + length)]
                else:
                    ranges = [(start + at, start + at + WINDOW) for at, other in earlier if other < order[row]]
                if ranges and row not in cover:
                    cover[row] = np.zeros(len(words) + 1, np.int32)
                for a, b in ranges:
                    cover[row][a] += 1
                    cover[row][b] -= 1
    out: list[tuple] = []
    for row, text in enumerate(texts):
        words = (text.as_py() or "").encode().split()
        gone: list[dict] = []
        total = len(words)
        if row in cover:
            marks = np.concatenate([[False], np.cumsum(cover[row])[:-1] > 0, [False]])
            edges = np.flatnonzero(marks[1:] != marks[:-1])
            gone = [{"start": a, "end": b} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]
            words = [w for w, m in zip(words, marks[1:-1].tolist(), strict=True) if not m]
        out.append((ids[row], total, total - len(words), b" ".join(words).decode(), gone))
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), SPAN]
    columns = zip(*out, strict=True) if out else [[]] * len(types)
    names = ["doc_id", "n_words", "n_removed", "kept_text", "removed"]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def block_count(docs: DataFrame) -> int:
    """Blocks of about ``BLOCK_BYTES`` of text, and no fewer than the session's shuffle partitions."""
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BLOCK_BYTES))


def deduplicate(docs: DataFrame, blocks: int | None = None) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text, removed`` (word ranges) for each row of ``docs``.

    ``blocks`` is the number of document blocks, each of which is handled in memory by one task; by default it
    follows from the measured size of the texts, so that a block does not grow with the corpus.
    """
    blocks = blocks or block_count(docs)
    # Rows without id are dealt by their text.
    place = F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.xxhash64("text")))
    docs = docs.select("doc_id", "text", F.pmod(place, F.lit(blocks)).cast("int").alias("block"))
    found = files.materialize(anchors(docs), "anchors")
    shared = found.groupBy("anchor").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count_if(F.col("doc_id").isNull()).alias("unnamed")
    )
    shared = shared.where("low < high OR (low IS NOT NULL AND unnamed > 0)").select("anchor")
    found = files.materialize(found.join(shared, "anchor"), "recurring")
    firsts = found.where("doc_id IS NOT NULL").groupBy("anchor", "phrase").agg(
        F.min(F.struct("doc_id", "at")).alias("place"), F.first("windows").alias("windows")
    )
    firsts = firsts.select("anchor", "phrase", F.col("place.doc_id").alias("first"), "place.at", "windows")
    firsts = files.materialize(firsts, "firsts")
    several = firsts.groupBy("anchor").agg((F.count("*") > 1).alias("several"))
    phrases = files.materialize(phrase_texts(docs, firsts.join(several, "anchor")), "phrases")

    windows = phrases.where("several").select("anchor", "phrase", "first", F.posexplode("hashes").alias("at", "window"))
    # Written, so that the join has plain scans on both sides and a frequent window is split between tasks.
    starts = files.materialize(windows.groupBy("anchor", "window").agg(F.min("first").alias("other")), "starts")
    earlier = windows.join(starts, ["anchor", "window"]).where("other < first")
    earlier = earlier.groupBy("anchor", "phrase").agg(
        F.collect_list(F.struct("at", F.col("other").alias("first"))).alias("earlier")
    )
    earlier = files.materialize(earlier, "earlier")

    known = firsts.select("anchor", "phrase", "first").join(earlier, ["anchor", "phrase"], "left")
    wanted = found.select("anchor", "phrase", "doc_id", "block").join(known, ["anchor", "phrase"], "left")
    wanted = wanted.where("doc_id IS NULL OR doc_id > first OR earlier IS NOT NULL").select("anchor", "phrase", "block").distinct()
    dealt = wanted.join(phrases.select("anchor", "phrase", "first", "text"), ["anchor", "phrase"])
    left = docs.select("doc_id", "text", "block")
    right = dealt.join(earlier, ["anchor", "phrase"], "left").select("block", "first", "text", "earlier")
    return left.groupBy("block").cogroup(right.groupBy("block")).applyInArrow(locate, KEPT)
