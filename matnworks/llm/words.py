"""Words, lines and rolling hashes of Arrow text columns, computed on whole buffers with numpy.

A word is a maximal run of bytes that are not ASCII white space (``\\x20`` and ``\\x09-\\x0D``); UTF-8
letters are never split. Hashes are 64-bit polynomials over bytes or word hashes with a final mix, equal
for equal content wherever it stands. A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from matnworks.llm.worker import keep

BASE = 0x9E3779B97F4A7C15
SLICE_BYTES = 1_000_000

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each, held once in a process."""
    held = keep("powers", lambda: [np.ones(1, np.uint64), np.ones(1, np.uint64)])
    if len(held[0]) < n:
        for i, step in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            steps = np.full(max(n, 2 * SLICE_BYTES), step, np.uint64)
            steps[0] = 1
            held[i] = np.cumprod(steps)
    return held[0], held[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def rolling(values: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive values; one entry per start that has ``n`` values."""
    count = len(values) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    if n <= 6:
        out = values[:count].copy()
        for i in range(1, n):
            out *= np.uint64(BASE)
            out += values[i : i + count]
        return mix(out)
    powers, inverse = _tables(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * inverse[: len(values)], out=total[1:])
    return mix((total[n:] - total[:-n]) * powers[:count])


class Texts:
    """The texts of a few rows as one byte buffer with the places of rows and words."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        size = int(offsets[-1] - offsets[0])
        buffer = column.buffers()[2]
        self.bytes = np.frombuffer(buffer, np.uint8, size, int(offsets[0])) if size else np.zeros(0, np.uint8)
        self.bounds = offsets - offsets[0]
        self.rows = len(column)
        self._sums: np.ndarray | None = None
        inside = ~SPACE[self.bytes]
        edge = np.zeros(size + 1, bool)
        edge[self.bounds] = True
        before = np.zeros(size, bool)
        after = np.zeros(size, bool)
        if size:
            before[1:] = inside[:-1]
            after[:-1] = inside[1:]
        self.inside = inside
        self.start = np.flatnonzero(inside & (~before | edge[:-1]))
        self.end = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, self.bounds)
        self.counts = np.diff(self.first)

    def raw(self, row: int) -> bytes:
        return self.bytes[self.bounds[row] : self.bounds[row + 1]].tobytes()

    def word_rows(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), self.counts)

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        """Sum over the bytes of each row."""
        return self.between(flags, self.bounds[:-1], self.bounds[1:])

    @staticmethod
    def between(flags: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[end] - total[start]

    def characters(self) -> np.ndarray:
        """Flags of the bytes that begin a code point."""
        return (self.bytes & 0xC0) != 0x80

    def hashes(self, start: np.ndarray, end: np.ndarray, data: np.ndarray | None = None) -> np.ndarray:
        """Content hashes of byte ranges; ``data`` replaces the bytes (lower case, say)."""
        powers, inverse = _tables(len(self.bytes) + 1)
        if data is not None or self._sums is None:
            values = (self.bytes if data is None else data).astype(np.uint64)
            values += np.uint64(1)
            values *= inverse[: len(values)]
            sums = np.zeros(len(values) + 1, np.uint64)
            np.cumsum(values, out=sums[1:])
            if data is None:
                self._sums = sums
        else:
            sums = self._sums
        out = (sums[end] - sums[start]) * powers[start]
        return mix(out + (end - start).astype(np.uint64))

    def lower(self) -> np.ndarray:
        """The bytes with A-Z in lower case."""
        upper = (self.bytes >= 65) & (self.bytes <= 90)
        return self.bytes + (upper * np.uint8(32))

    def word_hashes(self, data: np.ndarray | None = None) -> np.ndarray:
        return self.hashes(self.start, self.end, data)

    def windows(self, n: int) -> np.ndarray:
        """Flags, one per word: ``n`` words of the same row start here."""
        return np.arange(len(self.start)) + n <= np.repeat(self.first[1:], self.counts)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches, cut so that each holds at most ``SLICE_BYTES`` of text, or one row."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(batch.schema.get_field_index(text))).fill_null(0)
        ends = np.cumsum(np.asarray(sizes, dtype=np.int64))
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + SLICE_BYTES, "right")))
            yield batch.slice(at, to - at)
            at = to


def spans(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Content hashes of ranges of values of any length."""
    powers, inverse = _tables(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * inverse[: len(values)], out=total[1:])
    return mix((total[end] - total[start]) * powers[start] + (end - start).astype(np.uint64))


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` consecutive values, in linear time whatever the width."""
    count = len(values) - width + 1
    if count <= 0:
        return values[:0]
    size = -(-len(values) // width) * width
    padded = np.full(size, np.uint64(2**64 - 1), np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])
