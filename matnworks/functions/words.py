"""Cleaning and features of whole Arrow batches: words as ranges of a buffer.

The column expressions of ``arabic`` and ``stylometry`` make a string of every word of every row and compare it
many times. Here numpy cuts the buffer of a batch into words, Arrow numbers the distinct ones and matches the
patterns on these, and stems are cut as ranges of characters; no word becomes a Python object. Results are those
of the expressions, to the last bit. No match of a pattern leaves its white-space separated word, but for the one
white-space character that ends a genitive marker.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from matnworks.fixed_values import PREPOSITIONS, PUNCTUATION, STEM_MIN_LENGTH, STEM_PREFIXES, STEM_SUFFIXES, STOPWORDS
from matnworks.functions import patterns
from matnworks.functions.arabic import REMOVED, UNIFIED_FROM, UNIFIED_TO
from matnworks.functions.stylometry import _share

# Executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLICE_BYTES = 4_000_000

# White space as ``patterns.SPACE`` has it, by its UTF-8 bytes.
SPACES = [*range(0x09, 0x0E), *range(0x1C, 0x20), 0x85, 0x20, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

COUNTS = ("digits", "marks", "adjectives", "genitives")
FEATURES_TYPE = "digits long, marks long, adjectives long, genitives long, gini double"


# The same matches in the syntax of Arrow, on one word: a run of word characters is matched with the mark that ends it.
ADJECTIVE = rf"ال[{patterns.WORD}]+ي(?:[^{patterns.WORD}]|$)"
GENITIVE = rf"(?:^|[^{patterns.WORD}])(?:{'|'.join(PREPOSITIONS)})$"

# U+0600 to U+06FF, as numbers from 0.
ARABIC = 0x600


def _space_tables() -> tuple[np.ndarray, np.ndarray, dict[int, np.ndarray]]:
    """Bytes that are white space, bytes that may begin longer ones, and those as numbers by their length."""
    one, lead, longer = np.zeros(256, bool), np.zeros(256, bool), {2: [], 3: []}
    for code in SPACES:
        data = chr(code).encode()
        if len(data) == 1:
            one[data[0]] = True
        else:
            lead[data[0]] = True
            longer[len(data)].append(int.from_bytes(data, "big"))
    return one, lead, {n: np.array(found) for n, found in longer.items()}


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Parts of at most ``SLICE_BYTES`` of text, or of one row; null is the empty text."""
    texts = texts.cast(pa.string()).fill_null("")
    ends = np.cumsum(np.asarray(pc.binary_length(texts), np.int64))
    at = 0
    while at < len(texts):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + SLICE_BYTES, "right")))
        yield texts.slice(at, to - at)
        at = to


def _buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows, and where each row begins; the last entry is the end."""
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    held = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return held[at[0] : at[-1]], (at - at[0]).astype(np.int64)


class Words:
    """The white-space separated words of some texts: their numbers in ``distinct``, and the bounds of each row's."""

    def __init__(self, texts: pa.Array, spaces: tuple[np.ndarray, np.ndarray, dict[int, np.ndarray]]):
        data, rows = _buffer(texts)
        one, lead, longer = spaces
        ink = ~one[data]
        at = np.flatnonzero(lead[data])
        for size, known in longer.items():
            whole = at[at + size <= len(data)]
            number = np.zeros(len(whole), np.int64)
            for i in range(size):
                number = number << 8 | data[whole + i]
            whole = whole[np.isin(number, known)]
            for i in range(size):
                ink[whole + i] = False
        begins, ends = ink.copy(), ink.copy()
        begins[1:] &= ~ink[:-1]
        ends[:-1] &= ~ink[1:]
        some = rows[:-1] < rows[1:]
        first, last = rows[:-1][some], rows[1:][some] - 1
        begins[first] = ink[first]
        ends[last] = ink[last]
        start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.bounds = np.searchsorted(start, rows)
        self.rows = np.repeat(np.arange(len(rows) - 1), np.diff(self.bounds))
        self.spaced = stop < rows[1:][self.rows]  # white space follows in the row
        offsets = np.concatenate([[0], np.cumsum(stop - start)]).astype(np.int32)
        words = pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(data[ink]))
        words = words.dictionary_encode()
        self.codes = np.asarray(words.indices).astype(np.int64)
        self.distinct = words.dictionary

    def per_row(self, numbers: np.ndarray) -> np.ndarray:
        """The sum over each row's words."""
        return np.diff(np.concatenate([[0], np.cumsum(numbers)])[self.bounds])

    def gini(self) -> np.ndarray:
        """Gini coefficient of the word frequencies of each row: 2*sum(i*f_i)/(n*F) - (n+1)/n over ascending f."""
        keys = np.sort(self.rows * max(1, len(self.distinct)) + self.codes)
        new = np.flatnonzero(np.diff(keys, prepend=-1))
        times = np.diff(new, append=len(keys))
        row = keys[new] // max(1, len(self.distinct))
        order = np.lexsort((times, row))
        times, row = times[order], row[order]
        n = np.bincount(row, minlength=len(self.bounds) - 1)
        rank = np.arange(len(row)) - (np.cumsum(n) - n)[row] + 1
        some = n > 0
        weighted = np.add.reduceat(rank * times, (np.cumsum(n) - n)[some]) if some.any() else np.zeros(0, np.int64)
        mass, n = np.diff(self.bounds)[some], n[some]
        out = np.zeros(len(some))
        out[some] = (weighted * 2).astype(float) / (n * mass).astype(float) - (n.astype(float) + 1) / n.astype(float)
        return out


def _digits(data: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """ASCII and Arabic digits in each row."""
    found = (data >= 0x30) & (data <= 0x39)
    found[1:] |= (data[:-1] == 0xD9) & (data[1:] >= 0xA0) & (data[1:] <= 0xA9)
    return np.diff(np.searchsorted(np.flatnonzero(found), rows))


def _marks(data: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Distinct punctuation marks in each row."""
    pairs = []
    for size in (1, 2):
        known = {mark.encode(): number for number, mark in enumerate(PUNCTUATION) if len(mark.encode()) == size}
        last = np.zeros(256, bool)
        last[[mark[-1] for mark in known]] = True
        at = np.flatnonzero(last[data])
        at = at[at >= size - 1]
        for mark, number in known.items():
            here = at[data[at] == mark[-1]]
            if size == 2:
                here = here[data[here - 1] == mark[0]]
            pairs.append(np.unique(np.searchsorted(rows, here, "right") - 1))
    return np.bincount(np.concatenate(pairs), minlength=len(rows) - 1)


def _feature_counts(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    spaces = _space_tables()
    for array in texts:
        parts = []
        for part in _slices(array):
            words = Words(part, spaces)
            adjectives = np.asarray(pc.count_substring_regex(words.distinct, ADJECTIVE), np.int64)
            genitives = np.asarray(pc.match_substring_regex(words.distinct, GENITIVE).cast(pa.int64()))
            numbers = [
                _digits(*_buffer(part)),
                _marks(*_buffer(part)),
                words.per_row(adjectives[words.codes]),
                words.per_row(genitives[words.codes] * words.spaced),
            ]
            columns = [*(pa.array(x, pa.int64()) for x in numbers), pa.array(words.gini())]
            parts.append(pa.StructArray.from_arrays(columns, [*COUNTS, "gini"]))
        yield pa.concat_arrays(parts) if parts else pa.array([], FEATURES_ARROW)


FEATURES_ARROW = pa.struct([*((c, pa.int64()) for c in COUNTS), ("gini", pa.float64())])


def _numbers(word: str) -> list[int]:
    return [ord(c) - ARABIC for c in word]


def _packed(numbers: list[int], base: int) -> int:
    out = 0
    for number in numbers:
        out = out * base + number
    return out


class Cleaner:
    """``arabic.clean_text`` with the fixed lists, on the numbers of Arabic characters."""

    def __init__(self):
        self.unified = np.arange(256, dtype=np.uint8)
        self.unified[_numbers(UNIFIED_FROM)] = _numbers(UNIFIED_TO)
        self.stays = np.ones(256, bool)
        self.stays[_numbers(REMOVED)] = False
        stops = [_numbers(w) for w in STOPWORDS if len(w) > 1]
        self.longest = max(map(len, stops))
        self.stop_begins = np.zeros(1 << 16, bool)
        self.stop_begins[[_packed(w[:2], 256) for w in stops]] = True
        self.stops = np.array([_packed([n + 1 for n in w] + [0] * (self.longest - len(w)), 257) for w in stops])
        self.suffixes = np.zeros(1 << 16, bool)
        self.suffixes[[_packed(_numbers(s), 256) for s in STEM_SUFFIXES]] = True
        self.prefixes = [(len(p), _packed(_numbers(p), 256)) for p in STEM_PREFIXES]
        if self.longest > 7 or max(m for m, _ in self.prefixes) > 3 or {*map(len, STEM_SUFFIXES)} != {2}:
            raise ValueError("the lists do not fit the packed numbers")

    def _pieces(self, data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Unified characters, the length of each run of them, and the bounds of each row's runs."""
        lead = np.flatnonzero((data >= 0xD8) & (data <= 0xDB))
        numbers = (data[lead] - 0xD8) << 6 | data[lead + 1] & 0x3F
        bounds = np.searchsorted(lead, rows)
        new = np.ones(len(lead), bool)
        new[1:] = np.diff(lead) != 2
        new[bounds[:-1][bounds[:-1] < bounds[1:]]] = True
        before = np.concatenate([[0], np.cumsum(new)])
        stays = self.stays[numbers]
        sizes = np.diff(np.concatenate([[0], np.cumsum(stays)])[np.append(np.flatnonzero(new), len(new))])
        return self.unified[numbers[stays]], sizes, before[bounds]

    def _content(self, numbers: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Words of two characters or more that are no stop words; ``numbers`` is padded."""
        begin = numbers[start].astype(np.int64) << 8 | numbers[start + 1]
        maybe = np.flatnonzero((size > 1) & (size <= self.longest) & self.stop_begins[begin])
        key = np.zeros(len(maybe), np.int64)
        for i in range(self.longest):
            key = key * 257 + np.where(i < size[maybe], numbers[start[maybe] + i].astype(np.int64) + 1, 0)
        out = size > 1
        out[maybe[np.isin(key, self.stops)]] = False
        return out

    def _stemmed(self, numbers: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        head = (numbers[start].astype(np.int32) << 8 | numbers[start + 1]) << 8 | numbers[start + 2]
        cut = np.zeros(len(start), np.int64)
        for length, value in reversed(self.prefixes):  # the first that fits is set last
            cut[(head >> 8 * (3 - length) == value) & (size >= length + STEM_MIN_LENGTH)] = length
        start, size = start + cut, size - cut
        end = start + size
        tail = numbers[end - 2].astype(np.int32) << 8 | numbers[end - 1]
        return start, size - 2 * (self.suffixes[tail] & (size >= 2 + STEM_MIN_LENGTH))

    def clean(self, texts: pa.Array) -> pa.Array:
        numbers, size, bounds = self._pieces(*_buffer(texts))
        start = np.cumsum(size) - size
        numbers = np.concatenate([numbers, np.zeros(self.longest, np.uint8)])
        kept = self._content(numbers, start, size)
        bounds = np.concatenate([[0], np.cumsum(kept)])[bounds]
        start, size = self._stemmed(numbers, start[kept], size[kept])
        blank = np.ones(len(start), np.int64)  # before each word but the first of a row
        blank[bounds[:-1][bounds[:-1] < bounds[1:]]] = 0
        ends = np.concatenate([[0], np.cumsum(2 * size + blank)])
        done = np.cumsum(size) - size
        of = np.arange(size.sum())
        chosen = numbers[of + np.repeat(start - done, size)]
        at = 2 * of + np.repeat(ends[:-1] + blank - 2 * done, size)
        out = np.full(ends[-1], 0x20, np.uint8)
        out[at] = 0xD8 + (chosen >> 6)
        out[at + 1] = 0x80 | chosen & 0x3F
        return pa.StringArray.from_buffers(
            len(texts), pa.py_buffer(ends[bounds].astype(np.int32)), pa.py_buffer(out)
        )


def _cleaned(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    cleaner = Cleaner()
    for array in texts:
        parts = [cleaner.clean(part) for part in _slices(array)]
        yield pa.concat_arrays(parts) if parts else pa.array([], pa.string())


def _udf(run, kind: str):
    run.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, kind)


def clean_text(text: Column) -> Column:
    """``arabic.clean_text`` by batches, with the fixed lists."""
    return F.coalesce(_udf(_cleaned, "string")(text), F.lit(""))


def features(text: Column) -> dict[str, Column]:
    """``stylometry.features`` by batches."""
    found = _udf(_feature_counts, FEATURES_TYPE)(text)
    number = {c: F.coalesce(found[c], F.lit(0)) for c in COUNTS}
    return {
        "f3_digits_ratio": _share(number["digits"], F.length(text)),
        "f24_punct_div": _share(number["marks"], F.length(text)),
        "f45_adj_count": number["adjectives"].cast("double"),
        "f66_genitive_count": number["genitives"].cast("double"),
        "f87_gini": F.coalesce(found["gini"], F.lit(0.0)),
    }
