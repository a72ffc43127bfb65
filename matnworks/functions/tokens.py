"""Token arrays and what can be computed from one array without leaving its row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from matnworks.functions import patterns


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``.

    A lambda body is evaluated for every array element, so an expression that it mentions
    directly would be computed again each time.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def raw_tokens(text: Column) -> Column:
    """Runs of non-space characters; any Unicode white space separates."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), patterns.SPACE_RUN), "")


def bigrams(tokens: Column) -> Column:
    """Adjacent token pairs, joined with a space. Linear in the number of tokens."""
    return bind(
        tokens,
        lambda t: F.when(
            F.size(t) > 1,
            F.zip_with(
                F.slice(t, F.lit(1), F.size(t) - 1),
                F.slice(t, F.lit(2), F.size(t) - 1),
                lambda a, b: F.concat_ws(" ", a, b),
            ),
        ).otherwise(F.array().cast("array<string>")),
    )


def run_counts(tokens: Column) -> Column:
    """``array<struct<word, n>>``: each distinct token with its count, in token order.

    Sorts the tokens and cuts the sorted array where the token changes, which is n log n. Counting
    every distinct token with a filter would be quadratic in a long document.
    """

    def cut(ordered: Column) -> Column:
        ends = F.array_compact(
            F.transform(
                ordered,
                lambda w, i: F.when(
                    ~w.eqNullSafe(F.get(ordered, i + 1)), F.struct(w.alias("word"), (i + 1).alias("stop"))
                ),
            )
        )
        return bind(
            ends,
            lambda e: F.transform(
                e,
                lambda x, i: F.struct(
                    x["word"].alias("word"),
                    (x["stop"] - F.coalesce(F.get(e, i - 1)["stop"], F.lit(0))).alias("n"),
                ),
            ),
        )

    return bind(F.sort_array(tokens), cut)


def frequencies(tokens: Column) -> Column:
    """Ascending counts of the distinct tokens of one array."""

    def cut(ordered: Column) -> Column:
        ends = F.array_compact(
            F.transform(ordered, lambda w, i: F.when(~w.eqNullSafe(F.get(ordered, i + 1)), i + 1))
        )
        return bind(
            ends,
            lambda e: F.sort_array(F.transform(e, lambda x, i: x - F.coalesce(F.get(e, i - 1), F.lit(0)))),
        )

    return bind(F.sort_array(tokens), cut)


def total(numbers: Column) -> Column:
    """Sum of an integer array as bigint."""
    return F.aggregate(numbers, F.lit(0).cast("bigint"), lambda acc, x: acc + x)
