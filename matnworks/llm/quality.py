"""Quality rules on repetition coverage.

Rolling hashes of several n-gram lengths mark every n-gram that a text holds twice or more; the share of
the text's characters inside marked n-grams, and inside repeated lines, decides. Work and memory are
linear in the text: a longer n-gram can only repeat where a shorter one does, so only the shortest length
is sorted over all positions.

Words in a repeated long n-gram stand in repeated shorter ones too, so the shares fall with the length, and so do
the limits: a long repeat is rarer than a phrase that recurs and weighs more. The share of lines counts repetitions
alone, not the first line. ``symbol_heavy`` is a further column and no part of the verdict.

Null text: no words, rejected. Empty tables give no rows. Repeated rows are judged one by one, each on its
own text. Columns of other names than ``doc_id`` and ``text`` are ignored by ``measure`` and kept by ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from matnworks.llm.words import Texts, mix, rolling, slices

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Rules:
    """Limits: percentages of a text's characters, and of its words for the base rules."""

    min_words: int = 50
    max_repeat_words: int = 50
    max_line_chars: int = 20
    max_gram_chars: dict[int, int] = field(default_factory=lambda: {3: 40, 5: 36, 8: 32, 12: 28})
    many_symbols: int = 20


MEASURES = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, dup_line_chars long, dup_gram_chars array<long>, symbol_heavy boolean"
)


def repeated(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Flags of the entries whose (row, hash) occurs at least twice."""
    keys = mix(hashes + rows.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    order = np.argsort(keys)
    ranked = keys[order]
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = ranked[1:] == ranked[:-1]
    out = np.zeros(len(keys), bool)
    out[order] = same[1:] | same[:-1]
    return out


def later(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Flags of the entries equal to an earlier one of their row."""
    keys = mix(hashes + rows.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    out = np.zeros(len(keys), bool)
    out[order[1:]] = ranked[1:] == ranked[:-1]
    return out


def spread(marks: np.ndarray, n: int) -> np.ndarray:
    """Flags of the words inside a marked window of ``n`` words."""
    total = np.zeros(len(marks) + n, np.int32)
    np.cumsum(marks, out=total[n:])
    return total[n:] > total[: len(marks)]


def _sum(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def lines_of(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every line; a row of text has one line more than newlines."""
    breaks = np.flatnonzero(t.bytes == 10)
    start = np.sort(np.concatenate([t.bounds[:-1], breaks + 1]), kind="stable")
    rows = np.repeat(np.arange(t.rows), 1 + t.per_row(t.bytes == 10))
    end = np.sort(np.concatenate([t.bounds[1:], breaks]), kind="stable")
    return start, end, rows


def measures(t: Texts, lengths: list[int]) -> dict[str, np.ndarray]:
    begins = t.characters()
    chars = t.between(begins, t.start, t.end)
    rows, words = t.word_rows(), t.word_hashes()

    start, end, line_rows = lines_of(t)
    full = t.between(t.inside, start, end) > 0
    start, end, line_rows = start[full], end[full], line_rows[full]
    again = later(t.hashes(start, end), line_rows)
    line_chars = t.between(begins & t.inside, start, end) * again
    by_line = np.searchsorted(line_rows, np.arange(t.rows + 1))

    covered, at = {}, np.flatnonzero(t.windows(3))
    for n in sorted({3, *lengths}):
        at = at[t.windows(n)[at]] if n > 3 else at
        grams = rolling(words, n)[at] if len(at) else np.zeros(0, np.uint64)
        at = at[repeated(grams, rows[at])]
        marks = np.zeros(len(words), bool)
        marks[at] = True
        covered[n] = spread(marks, n)
    return {
        "n_words": t.counts,
        "word_chars": _sum(chars, t.first),
        "n_symbols": t.per_row(SYMBOLS[t.bytes]),
        "n_dup_lines": _sum(again, by_line),
        "n_repeat_words": _sum(covered[3], t.first),
        "dup_line_chars": _sum(line_chars, by_line),
        "dup_gram_chars": np.stack([_sum(chars * covered[n], t.first) for n in lengths], axis=1),
    }


def verdict(m: dict[str, np.ndarray], rules: Rules) -> tuple[np.ndarray, np.ndarray]:
    failed = (m["n_words"] < rules.min_words) | (100 * m["n_repeat_words"] > rules.max_repeat_words * m["n_words"])
    limits = np.array([rules.max_gram_chars[n] for n in sorted(rules.max_gram_chars)])
    repeats = (100 * m["dup_gram_chars"] > limits * m["word_chars"][:, None]).any(axis=1)
    lines = 100 * m["dup_line_chars"] > rules.max_line_chars * m["word_chars"]
    return failed, ~(failed | repeats | lines)


def measure(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row of measures and the verdict for each row of ``docs`` (``doc_id``, ``text``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = sorted(rules.max_gram_chars)
        for batch in slices(batches):
            m = measures(Texts(batch.column(1)), lengths)
            m["base_failed"], m["kept"] = verdict(m, rules)
            grams = m.pop("dup_gram_chars")
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column(0)}
                | {k: m[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
                | {"base_failed": m["base_failed"], "kept": m["kept"], "dup_line_chars": m["dup_line_chars"]}
                | {"dup_gram_chars": pa.array(list(grams), pa.list_(pa.int64()))}
                | {"symbol_heavy": 100 * m["n_symbols"] > rules.many_symbols * m["n_words"]}
            )

    return docs.select("doc_id", "text").mapInArrow(run, MEASURES)


def keep(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows that pass the rules, with all their columns, in one pass without a join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = sorted(rules.max_gram_chars)
        for batch in slices(batches):
            text = batch.column(batch.schema.get_field_index("text"))
            yield batch.filter(pa.array(verdict(measures(Texts(text), lengths), rules)[1]))

    return docs.mapInArrow(run, docs.schema)
