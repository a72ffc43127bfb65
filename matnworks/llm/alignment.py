"""Alignment of two tokenizers over one corpus.

Both tokenizers cut the bytes of "space + text" into tokens. Offsets where tokens of both end cut the text into
groups; the two last tokens of a group are linked, and a link counts for its pair of ids in the whole corpus.

A text is cut at blanks that neither tokenizer crosses (the byte-level pattern begins a token there; no entry of
the other vocabulary, which is checked, has a blank behind another character), so the groups of a blank-separated
word can be kept; at most ``KEPT_WORDS`` are. A document of more than ``CHUNK`` bytes becomes byte ranges that Spark
deals to tasks. A range is tokenized with the text around it up to such a blank and owns the tokens that end in it:
a fragment with an open prefix (to the first common end), closed groups, and an open suffix. Fragments form a
monoid: where two meet, suffix and prefix close to a group. Documents are composed by a tree of rounds, ``FAN``
fragments of one document at a time.

How often a pair of ids is linked is a table bounded by the vocabularies, whatever the corpus: of two tokens that
end together one is a suffix of the other, so there are at most as many pairs as bytes in both vocabularies.
``bound`` computes that number; the table is checked against it before it is sent to the tasks.

Null and empty texts, and texts that a tokenizer does not give back byte for byte, have no tokens: zeros and an
empty digest. Null and repeated ids: each row is a document of its own, and its links count. Empty tables give
no rows. Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matnworks.llm.words import slices
from matnworks.llm.worker import keep
from matnworks.sources import files

CHUNK = 1 << 16
FAN = 8
KEPT_WORDS = 50_000
LEARNED_WORDS = 5_000
LONGEST_KEPT = 64
SCORED_ROWS = 200
BLANK = "▁"

# A blank, not behind a blank and before a character that is surely no white space.
CUT = re.compile(r"(?<! ) (?=\S)")
BYTE_CUT = re.compile(rb"(?<! ) (?=[\x21-\x7E\xC3-\xDF\xE4-\xF4])")

DOCUMENT = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links array<int>"
DOCUMENT_NAMES = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links"]
DOCUMENT_TYPES = [*[pa.int64()] * 4, pa.string(), pa.list_(pa.int32())]
RANGE = "part int, row long, doc_id long, chunk long, begin long, start long, stop long, data binary"
RANGE_NAMES = [x.split(" ")[0] for x in RANGE.split(", ")]
RANGE_TYPES = [pa.int32(), *[pa.int64()] * 6, pa.binary()]
FRAGMENT = (
    "part int, row long, doc_id long, chunk long, valid boolean, n_a long, n_b long, n_groups long, head_a array<int>, "
    "head_b array<int>, closed string, tail_a array<int>, tail_b array<int>, links array<int>"
)
FRAGMENT_NAMES = [x.split(" ")[0] for x in FRAGMENT.split(", ")]
_IDS = pa.list_(pa.int32())
FRAGMENT_TYPES = [
    pa.int32(), *[pa.int64()] * 3, pa.bool_(), *[pa.int64()] * 3, _IDS, _IDS, pa.string(), _IDS, _IDS, _IDS
]
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def shown(a: list[int], b: list[int]) -> str:
    return ",".join(map(str, a)) + "|" + ",".join(map(str, b))


class Fragment(NamedTuple):
    """``head``: the tokens to the first common end, or all if there is none; ``tail``: those behind the last one."""

    n_groups: int
    head_a: list[int]
    head_b: list[int]
    closed: str
    tail_a: list[int]
    tail_b: list[int]

    def then(self, other: Fragment) -> Fragment:
        """The fragment of both ranges, one behind the other."""
        if not self.n_groups:
            return other._replace(head_a=self.head_a + other.head_a, head_b=self.head_b + other.head_b)
        a, b = self.tail_a + other.head_a, self.tail_b + other.head_b
        if not other.n_groups:
            return self._replace(tail_a=a, tail_b=b)
        closed = ";".join(x for x in (self.closed, shown(a, b), other.closed) if x)
        return Fragment(self.n_groups + other.n_groups, self.head_a, self.head_b, closed, other.tail_a, other.tail_b)

    def groups(self) -> str:
        """The groups of a whole document: it begins at a common offset and ends at one."""
        return ";".join(x for x in (shown(self.head_a, self.head_b), self.closed) if x)


EMPTY = Fragment(0, [], [], "", [], [])


class Tokens:
    """Both tokenizers with the bytes of their entries. ``ranks`` and ``pattern``: byte-level; ``model``: pieces."""

    def __init__(self, ranks: str, pattern: str, model: str):
        import sentencepiece
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.plain = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=model)
        self.a = [b""] * (max(table.values()) + 1)
        for token, rank in table.items():
            self.a[rank] = token
        ids = range(self.pieces.get_piece_size())
        texts = [self.pieces.id_to_piece(i) for i in ids]
        if any(BLANK in t.lstrip(BLANK) for t in texts):
            raise ValueError("an entry has a blank behind another character")
        self.b = [
            bytes([int(t[3:5], 16)]) if self.pieces.is_byte(i) else t.replace(BLANK, " ").encode()
            for i, t in zip(ids, texts, strict=True)
        ]
        if len(self.a) * len(self.b) > 2**31:
            raise ValueError("a pair of ids must fit in 31 bits")
        self.width = len(self.b)
        if [i for i, t in enumerate(self.a) if b"\0" in t] != [table[b"\0"]]:
            raise ValueError("the zero byte must be a token of its own only")
        self.zero = table[b"\0"]
        self.size_a, self.size_b = np.array([*map(len, self.a)]), np.array([*map(len, self.b)])
        # Each id with the sign that may stand behind it: in a group, between the sides, between groups, behind a word.
        self.shown = np.array([f"{i}{x}" for n in (len(self.a), len(self.b)) for i in range(n) for x in ",|;\n"], object)
        self.signed = 0, 4 * len(self.a)
        self.known: dict[str, tuple | None] = {}

    def bound(self) -> int:
        """The most pairs of ids that can end together: one of the two entries is a suffix of the other."""
        same = Counter(self.b)
        whole = set(self.a)
        longer_a = sum(same[t[-n:]] for t in self.a for n in range(1, len(t) + 1))
        longer_b = sum(t[-n:] in whole for t in self.b for n in range(1, len(t)))
        return longer_a + longer_b

    def words(self, text: str) -> list[str]:
        """The words of " " + text, each without its first blank."""
        first, *rest = CUT.split(" " + text)
        return [first[1:], *rest] if first else rest

    def left(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The byte-level ids of " " + word, one word behind the other, and their number for each word."""
        alone = {w for w in words if "\0" in w or w[-1:].isspace()}
        ids = np.array(self.plain.encode_ordinary("\0".join([" " + w for w in words if w not in alone])), np.int64)
        at = np.flatnonzero(ids == self.zero)
        if not alone:
            return ids[ids != self.zero], np.diff(at, prepend=-1, append=len(ids)) - 1
        joined = zip([0, *(at + 1)], [*at, len(ids)], strict=True)
        lists = [self.plain.encode_ordinary(" " + w) if w in alone else ids[slice(*next(joined))] for w in words]
        return np.concatenate(lists).astype(np.int64), np.array([*map(len, lists)])

    def right(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of the pieces."""
        lists = self.pieces.encode(words, num_threads=1)
        return np.fromiter(chain.from_iterable(lists), np.int64), np.array([*map(len, lists)])

    def valid(self, data: bytes, a: Iterable[int], b: Iterable[int]) -> bool:
        return b"".join(map(self.a.__getitem__, a)) == data == b"".join(map(self.b.__getitem__, b))

    def learn(self, words: list[str]) -> dict[str, tuple | None]:
        """For each word ``n_a, n_b, n_groups, groups, links``, or None if its bytes are not given back."""
        (a, n_a), (b, n_b) = self.left(words), self.right(words)
        data = [b" " + w.encode() for w in words]
        size = np.cumsum([*map(len, data)])
        stop_a, stop_b = np.cumsum(n_a), np.cumsum(n_b)
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        if not (
            self.valid(b"".join(data), a.tolist(), b.tolist())
            and (n_a * n_b > 0).all()
            and (end_a[stop_a - 1] == size).all()
            and (end_b[stop_b - 1] == size).all()
        ):
            parts = zip(data, np.split(a, stop_a[:-1]), np.split(b, stop_b[:-1]), strict=True)
            fine = [self.valid(d, x.tolist(), y.tolist()) for d, x, y in parts]
            rest = [w for w, ok in zip(words, fine, strict=True) if ok]
            return dict.fromkeys(words) | (self.learn(rest) if rest else {})
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        cut_a, cut_b = np.searchsorted(end_a, common), np.searchsorted(end_b, common)
        last = np.searchsorted(common, size)
        # Every token with the sign behind it, in order of (group, tokenizer).
        sign_a, sign_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        sign_a[cut_a], sign_b[cut_b] = 1, 2
        sign_b[cut_b[last]] = 3
        signed = np.concatenate([self.signed[0] + 4 * a + sign_a, self.signed[1] + 4 * b + sign_b])
        group = np.concatenate([2 * np.searchsorted(common, end_a), 2 * np.searchsorted(common, end_b) + 1])
        texts = "".join(self.shown[signed[np.argsort(group, kind="stable")]].tolist()).split("\n")
        links = (a[cut_a] * self.width + b[cut_b]).astype("<i4").tobytes()
        bounds = [0, *(last + 1).tolist()]
        spans = [links[4 * i : 4 * j] for i, j in zip(bounds[:-1], bounds[1:], strict=True)]
        return dict(zip(words, zip(n_a.tolist(), n_b.tolist(), np.diff(bounds).tolist(), texts, spans, strict=False), strict=True))

    def entries(self, texts: list[str]) -> Iterator[list[tuple | None]]:
        """The entries of the words of each text."""
        if len(self.known) > KEPT_WORDS:
            self.known = {}
        known = self.known
        cut = [self.words(text) for text in texts]
        new = list({w for words in cut for w in words if w not in known})
        found: dict[str, tuple | None] = {}
        for i in range(0, len(new), LEARNED_WORDS):
            found |= self.learn(new[i : i + LEARNED_WORDS])
        known.update((w, e) for w, e in found.items() if len(w) <= LONGEST_KEPT)
        found = {w: e for w, e in found.items() if len(w) > LONGEST_KEPT}
        for words in cut:
            yield [known[w] if w in known else found[w] for w in words]

    def fragment(self, data: bytes, begin: int, start: int, stop: int) -> tuple[bool, Fragment, list[int], int, int]:
        """Of the tokens of ``data`` (from offset ``begin`` on) those that end behind ``start``, up to ``stop``."""
        text = data.decode()
        a, b = self.plain.encode_ordinary(text), self.pieces.encode(text[1:])
        if not self.valid(data, a, b):
            return False, EMPTY, [], 0, 0
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        end_a, end_b = begin + np.cumsum(self.size_a[a]), begin + np.cumsum(self.size_b[b])
        own_a, own_b = (end_a > start) & (end_a <= stop), (end_b > start) & (end_b <= stop)
        a, b, end_a, end_b = a[own_a], b[own_b], end_a[own_a], end_b[own_b]
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        cut_a, cut_b = np.searchsorted(end_a, common) + 1, np.searchsorted(end_b, common) + 1
        links = (a[cut_a - 1] * self.width + b[cut_b - 1]).tolist()
        if not len(common):
            return True, Fragment(0, a.tolist(), b.tolist(), "", [], []), [], len(a), len(b)
        parts_a, parts_b = ([x.tolist() for x in np.split(ids, cut)] for ids, cut in ((a, cut_a), (b, cut_b)))
        closed = ";".join(map(shown, parts_a[1:-1], parts_b[1:-1]))
        whole = Fragment(len(common), parts_a[0], parts_b[0], closed, parts_a[-1], parts_b[-1])
        return True, whole, links, len(a), len(b)


def ranges(data: bytes, size: int) -> Iterator[tuple[int, int, int, int]]:
    """``begin, start, stop, end``: ranges of about ``size`` bytes, and the text around each between two cuts.

    A range whose text would reach more than ``size`` beyond it is extended to that cut, so texts around ranges
    are short and every byte is tokenized a few times at most, whatever stands between blanks.
    """
    cuts = np.array([m.start() for m in BYTE_CUT.finditer(data)] + [len(data)])
    start = begin = 0
    while start < len(data):
        stop = min(start + size, len(data))
        end = int(cuts[np.searchsorted(cuts, stop)])
        if end - stop > size:
            stop = end
        yield begin, start, stop, end
        before = int(np.searchsorted(cuts, stop, "right"))
        begin, start = int(cuts[before - 1]) if before else 0, stop


class Aligner:
    """The operator for one pair of tokenizers, given as for :class:`Tokens`."""

    def __init__(self, ranks: str, pattern: str, model: str, chunk: int = CHUNK):
        self.given = (ranks, pattern, model)
        self.chunk = chunk

    def short(self, docs: DataFrame) -> DataFrame:
        given = self.given

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tokens = keep((Tokens.__name__, *given), lambda: Tokens(*given))
            for batch in slices(batches):
                out = []
                for doc_id, entries in zip(batch.column(0).to_pylist(), tokens.entries(batch.column(1).fill_null("").to_pylist()), strict=True):
                    if not entries or None in entries:
                        out.append((doc_id, 0, 0, 0, "", None))
                        continue
                    n_a, n_b, n, groups, links = zip(*entries, strict=True)
                    digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
                    out.append((doc_id, sum(n_a), sum(n_b), sum(n), digest, b"".join(links)))
                yield documents(out)

        return docs.select("doc_id", "text").mapInArrow(run, DOCUMENT)

    def fragments(self, docs: DataFrame) -> DataFrame:
        """The fragments of the ranges of long documents; a document is known by the task and row that cut it."""
        given, size = self.given, self.chunk

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part, row = TaskContext.get().partitionId(), 0
            for batch in slices(batches):
                for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    data = b" " + text.encode()
                    for i, (begin, start, stop, end) in enumerate(ranges(data, size)):
                        yield table_of([(part, row, doc_id, i, begin, start, stop, data[begin:end])], RANGE_TYPES, RANGE_NAMES)
                    row += 1

        def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tokens = keep((Tokens.__name__, *given), lambda: Tokens(*given))
            for batch in batches:
                for i in range(batch.num_rows):
                    part, row, doc_id, chunk, begin, start, stop, data = (c[i].as_py() for c in batch.columns)
                    valid, whole, links, n_a, n_b = tokens.fragment(data, begin, start, stop)
                    yield table_of([(part, row, doc_id, chunk, valid, n_a, n_b, *whole, links)], FRAGMENT_TYPES, FRAGMENT_NAMES)

        # The ranges are dealt by their place in the input, before anything unstable could renumber them.
        dealt = files.materialize(docs.select("doc_id", "text").mapInArrow(cut, RANGE), "ranges")
        return files.materialize(dealt.repartition("part", "row", "chunk").mapInArrow(make, FRAGMENT), "fragments")

    def composed(self, fragments: DataFrame) -> DataFrame:
        """Documents from fragments, by rounds that join ``FAN`` neighbours of a document each."""

        def join(table: pa.Table) -> pa.Table:
            rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
            whole = EMPTY
            for r in rows:
                whole = whole.then(Fragment(*(r[x] for x in Fragment._fields)))
            first = rows[0]
            valid = all(r["valid"] for r in rows)
            figures = [sum(r[x] for r in rows) for x in ("n_a", "n_b")]
            links = [x for r in rows for x in r["links"]]
            row = (first["part"], first["row"], first["doc_id"], first["chunk"] // FAN, valid, *figures, *whole, links)
            return pa.Table.from_batches([table_of([row], FRAGMENT_TYPES, FRAGMENT_NAMES)])

        def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    r = {name: column[i].as_py() for name, column in zip(batch.schema.names, batch.columns, strict=True)}
                    out = (r["doc_id"], 0, 0, 0, "", None)
                    if r["valid"]:
                        whole = Fragment(*(r[x] for x in Fragment._fields))
                        digest = hashlib.sha256(whole.groups().encode()).hexdigest()
                        out = (r["doc_id"], r["n_a"], r["n_b"], whole.n_groups, digest, np.array(r["links"], "<i4").tobytes())
                    yield documents([out])

        most = fragments.agg(F.max("chunk")).first()[0] or 0
        while most:
            fragments = fragments.groupBy("part", "row", (F.col("chunk") / FAN).cast("long").alias("group")).applyInArrow(join, FRAGMENT)
            most //= FAN
            if not most:
                # A stage with two Python operators would keep twice as many workers, each with both tokenizers later.
                fragments = files.materialize(fragments, "composed")
        return fragments.mapInArrow(close, DOCUMENT)

    def documents(self, docs: DataFrame) -> DataFrame:
        """Counts, digest of the groups and links (``a * width + b``) of each document, written."""
        long = F.octet_length("text") > self.chunk
        few = self.short(docs.where(F.coalesce(~long, F.lit(True))))
        whole = self.composed(self.fragments(docs.where(long)))
        return files.materialize(few.union(whole), "aligned")

    def pairs(self, found: DataFrame) -> DataFrame:
        """``pair, n, most``: how often a pair of ids is linked, and the largest such number of its B id."""
        width = Tokens(*self.given).width
        counts = found.select(F.explode("links").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
        of_b = Window.partitionBy(F.col("pair") % width)
        return counts.withColumn("most", F.max("n").over(of_b))

    def align(self, docs: DataFrame) -> DataFrame:
        """One row for each row of ``docs`` (``doc_id``, ``text``): its tokens, groups and links."""
        found = self.documents(docs)
        table = self.pairs(found).toArrow()
        if table.num_rows > Tokens(*self.given).bound():
            raise RuntimeError("more pairs than the vocabularies allow")
        pair, n, most = (table.column(c).to_numpy() for c in ("pair", "n", "most"))
        order = np.argsort(pair)
        pair, n, best = pair[order], n[order], (n == most)[order]

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(0, batch.num_rows, SCORED_ROWS):
                    some = batch.slice(i, SCORED_ROWS)
                    links = some.column("links")
                    at = np.searchsorted(pair, links.flatten().to_numpy())
                    bounds = np.concatenate([[0], np.cumsum(links.value_lengths().fill_null(0).to_numpy())])
                    sums = [np.concatenate([[0], np.cumsum(x[at], dtype=np.int64)])[bounds] for x in (best, n)]
                    columns = [some.column(c) for c in DOCUMENT_NAMES[:4]]
                    columns += [pa.array(np.diff(x), pa.int64()) for x in (bounds, *sums)]
                    columns.append(some.column("groups_sha256"))
                    yield pa.RecordBatch.from_arrays(columns, [x.split(" ")[0] for x in ALIGNED.split(", ")])

        return found.mapInArrow(score, ALIGNED)


def table_of(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def documents(rows: list[tuple]) -> pa.RecordBatch:
    """Rows of ``DOCUMENT``; links are given as bytes."""
    *columns, links = zip(*rows, strict=True)
    data = b"".join(x or b"" for x in links)
    bounds = np.cumsum([0, *(len(x or b"") // 4 for x in links)]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.frombuffer(data, "<i4")))
    arrays = [pa.array(c, t) for c, t in zip(columns, DOCUMENT_TYPES[:-1], strict=True)]
    return pa.RecordBatch.from_arrays([*arrays, lists], DOCUMENT_NAMES)
