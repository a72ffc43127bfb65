"""Site-relative line deduplication in DataFrame functions only.

A line is boilerplate of a host if the host's pages that contain it, divided by all pages of the host,
exceed a ratio; pages with one text count once, so that a group of copies does not condemn its own lines.
Lines are counted by a 128-bit hash, combined before each shuffle and spread by page, so neither a common
line nor a large host meets in one task. A host has at most "mean lines of a page / ratio" boilerplate
lines, a short array that joins its pages; the join is broadcast only if its measured size allows, and
otherwise splits large hosts.

A line is compared without the ASCII white space around it, so a carriage return does not matter. It must be on two
different pages of the host at least; so a host with one page loses nothing, and a line of a small host that
is on a single page is not taken for boilerplate by the smallness of the host.

Null text: no lines, stays null. A null host is a host of its own. Lines of white space alone are never counted
or dropped. Empty tables give no rows. Repeated rows are one page, and each row of the result. All columns are
kept, whatever their names; ``n_lines`` and ``n_dropped`` take the place of columns with these names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matnworks.sources import files

RATIO = 0.1
WHITE = " \t\n\x0b\f\r"


def _key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit("second"), line).alias("b"))


def _bare(line: Column) -> Column:
    return F.trim(line, F.lit(WHITE))


def boilerplate(pages: DataFrame, host: str, ratio: float = RATIO) -> DataFrame:
    """``_line_host, _line_keys``: the keys of the lines of each host that exceed the ratio."""
    page = pages.where("text IS NOT NULL").select(
        F.col(f"`{host}`").alias("_line_host"), F.xxhash64("text", F.length("text")).alias("page"), F.split("text", "\n").alias("l")
    )
    lines = F.array_distinct(F.transform(F.filter("l", lambda x: _bare(x) != ""), lambda x: _key(_bare(x))))
    held = page.select("_line_host", "page", F.explode(lines).alias("k"))
    counts = held.groupBy("_line_host", "k.a", "k.b").agg(F.count_distinct("page").alias("n"))
    totals = page.groupBy("_line_host").agg(F.count_distinct("page").alias("total"))
    frequent = counts.where("n >= 2").join(
        totals.withColumnRenamed("_line_host", "_line_of"), F.expr("_line_host <=> _line_of")
    )
    frequent = frequent.where(F.col("n") > F.lit(ratio) * F.col("total"))
    return frequent.groupBy("_line_host").agg(F.collect_set(F.struct("a", "b")).alias("_line_keys"))


def drop_boilerplate(pages: DataFrame, host: str = "source", ratio: float = RATIO, counts: bool = True) -> DataFrame:
    """``pages`` with the kept lines in ``text``, and ``n_lines`` and ``n_dropped``, both without blank lines.

    Without ``counts`` the columns are those of ``pages``.
    """
    found = files.materialize(boilerplate(pages, host, ratio), "boilerplate")
    # The row travels as one column, so its names cannot meet those used here.
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"))
    met = rows.join(found, F.expr(f"row.`{host}` <=> _line_host"), "left")
    split, keys = F.split("row.text", "\n"), F.col("_line_keys")
    kept = F.when(
        keys.isNotNull(), F.filter(split, lambda x: (_bare(x) == "") | ~F.array_contains(keys, _key(_bare(x))))
    ).otherwise(split)
    full = lambda c: F.coalesce(F.size(F.filter(c, lambda x: _bare(x) != "")), F.lit(0)).cast("long")
    met = met.withColumn("kept", kept)
    if counts:
        met = met.withColumn("all", full(split)).withColumn("left", full(F.col("kept")))
    text = F.array_join("kept", "\n").alias("text")
    own = [text if c == "text" else F.col(f"row.`{c}`") for c in pages.columns if not counts or c not in ("n_lines", "n_dropped")]
    if not counts:
        return met.select(*own)
    some = lambda c: F.when(F.col("row.text").isNull(), F.lit(0).cast("long")).otherwise(c)
    return met.select(*own, some(F.col("all")).alias("n_lines"), some(F.col("all") - F.col("left")).alias("n_dropped"))
