"""Benchmark decontamination as a prefix-filtered containment join, in DataFrame functions only.

An item is cut into windows of consecutive words. A document contains a window only if it contains every
shingle of it, so the join prefix is one shingle: the window's rarest, counted over all documents. A document
position that holds this shingle gives one candidate start, bounded by the document's length; the candidate
stands if every other shingle of the window is found at its own position. Shingles are compared as strings, so
a verified window is an exact occurrence.

Documents are read and cut once; only places of shingles that items have, and one row per document, go on.

Null text: no words. Empty tables: no rows, or no hits. A document is a pair of id and text: rows that repeat both
are one, rows with one id (or without id) and different texts are judged and returned apart. Items
with equal ids are one item with the windows of all its rows; null item ids are ignored. Columns other than
``doc_id``, ``item_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matnworks.llm.rows import row_key
from matnworks.sources import files

SHINGLE = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Runs of lower-case letters, digits and characters beyond ASCII."""
    plain = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(plain, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")


def _shingles(column: str, size: int) -> Column:
    """Every run of ``size`` words as one string."""
    starts = F.expr(f"CASE WHEN size({column}) >= {size} THEN sequence(1, size({column}) - {size - 1}) ELSE array() END")
    parts = [F.col(column)]
    return F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(parts[0], i - 1 + k) for k in range(size)]))


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """``item_id, length, shingles`` of every window; an item of fewer words is one window."""
    cut = items.where("item_id IS NOT NULL").select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("w"))
    cut = cut.where("size(w) > 0").withColumn("length", F.least(F.size("w"), F.lit(window)))
    parts = cut.select("item_id", "length", F.explode(F.expr(
        "transform(sequence(1, size(w) - length + 1), i -> slice(w, i, length))")).alias("w")).distinct()
    short = [F.when(F.col("length") == n, _shingles("w", n)) for n in range(1, SHINGLE)]
    return parts.select("item_id", "length", "w", F.coalesce(*short, _shingles("w", SHINGLE)).alias("shingles"))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """``row, doc_id, n_words, n_hit, n_items, items, contaminated`` per document; ``row`` is its key in ``rows``.

    A word is hit inside any occurrence of a window of ``items`` (``item_id``, ``text``); ``items`` of the result
    are the ids of those with an occurrence, sorted as strings.
    """
    windows = files.materialize(item_windows(items, window), "windows")
    known = windows.select(F.explode("shingles").alias("shingle"))
    wanted = known.union(known.sparkSession.range(1).select(F.lit("").alias("shingle"))).distinct()
    wanted = files.materialize(wanted, "shingles")  # its measured size decides whether it is broadcast
    sizes = [r["n"] for r in windows.select(F.least("length", F.lit(SHINGLE)).alias("n")).distinct().collect()]
    cut = docs.select(row_key().alias("row"), "doc_id", words(F.col("text")).alias("w"))
    lists = [F.transform(_shingles("w", n), lambda s, i: F.struct((i + 1).alias("at"), s.alias("shingle"))) for n in sizes]
    total = F.array(F.struct(F.size("w").alias("at"), F.lit("").alias("shingle")))
    places = cut.select("row", "doc_id", F.explode(F.concat(*lists, total)).alias("p"))
    # The id stands at the row of the document only; its places have the key.
    doc_id = F.when(F.col("p.shingle") == "", F.col("doc_id")).alias("doc_id")
    places = files.materialize(places.select("row", doc_id, "p.at", "p.shingle").join(wanted, "shingle"), "places")
    lengths = places.where("shingle = ''").groupBy("row").agg(
        F.any_value("doc_id").alias("doc_id"), F.max("at").cast("long").alias("n_words")
    )
    places = places.where("shingle <> ''").select("row", "at", "shingle")

    counts = places.groupBy("shingle").agg(F.count("*").alias("n"))
    texts = windows.select("w", "length", "shingles").distinct()
    ordered = texts.select("w", "length", F.posexplode("shingles").alias("offset", "shingle")).join(counts, "shingle", "left")
    rarest = ordered.groupBy("w", "length").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "offset")).alias("prefix"),
        F.collect_list(F.struct("offset", "shingle")).alias("all"),
    )
    prefix = rarest.where("prefix.n > 0").select("w", "length", "all", "prefix.shingle", "prefix.offset")
    starts = places.join(prefix, "shingle").select("row", "w", "length", "all", (F.col("at") - F.col("offset")).alias("start"))
    starts = starts.join(lengths.select("row", "n_words"), "row").where("start >= 1 AND start + length - 1 <= n_words")
    parts = starts.select("row", "start", "w", "length", F.size("all").alias("needed"), F.explode("all").alias("s"))
    parts = parts.select("row", "start", "w", "length", "needed", (F.col("start") + F.col("s.offset")).alias("at"), "s.shingle")
    found = parts.join(places.distinct(), ["row", "at", "shingle"])
    found = found.groupBy("row", "start", "w", "length", "needed").agg(F.count_distinct("at").alias("n"))
    found = found.where("n = needed")
    found = files.materialize(found.select("row", "start", "w", "length"), "found")

    hit = found.select("row", F.explode(F.expr("sequence(start, start + length - 1)")).alias("at")).distinct()
    hit = hit.groupBy("row").agg(F.count("*").alias("n_hit"))
    names = found.join(windows.select("w", "item_id"), "w").select("row", "item_id").distinct()
    names = names.groupBy("row").agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    out = lengths.join(hit, "row", "left").join(names, "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    items_found = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        "row", "doc_id", "n_words", n_hit.alias("n_hit"), F.size(items_found).cast("long").alias("n_items"),
        items_found.alias("items"), (n_hit > 0).alias("contaminated"),
    )
