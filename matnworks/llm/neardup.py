"""Near-duplicate groups by SuperMinHash.

Each element of a document's shingle set takes the signature's slots in a random order of its own, and a
slot keeps the smallest of "rank plus a random fraction"; ranks are spread over the slots, so signatures
have less variance than independent hashes. Once every slot holds a value of an earlier rank, later ranks
cannot change it and a document stops.

Documents with one set are one class. Classes that agree in a band share a bucket, and a bucket is compared
as a star: each member with a centre, the one that meets most members over all its buckets, on full sets.
Members linked to their centre are in one component already. For any other linked pair of a star, the
differences from the centre must overlap in so many shingles that a prefix of each, shingles rare in the star
first, has one in common at places that leave room for the overlap. Pairs of such members from different
components are compared in turn. So every link between texts that meet in a band is found, and a bucket is
never expanded into all its pairs.

Classes are known by the digest of their set until the end, so ids decide nothing but the names of groups. Null or
empty text: an empty set, linked with nothing, kept. Empty tables give no rows. Repeated rows are repeated in the
result. One id with several texts: each row is linked by its own text. A row without id takes part; its group has
the smallest id in it, or none if no row has one. Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matnworks.llm.components import components
from matnworks.llm.rows import row_key
from matnworks.llm.words import Texts, mix, rolling, slices
from matnworks.sources import files

BANDS = 36
ROWS = 6

SIGNED = "doc_id long, row binary, n_shingles long, digest binary, bands array<long>"
SETS = "x binary, shingles array<long>"
STARS = "c binary, x binary, n_c long, n_x long, linked boolean, apart array<long>"

def super_minhash(hashes: np.ndarray, rows: np.ndarray, count: int, slots: int) -> np.ndarray:
    """Signatures of ``count`` rows; ``hashes`` are elements and ``rows`` their rows, in order."""
    empty = np.uint64(2**64 - 1)
    out = np.full(count * slots, empty, np.uint64)
    places = None
    for rank in range(slots):
        random = mix(hashes + np.uint64((rank + 1) * 0x9E3779B97F4A7C15 % 2**64))
        pick = rank + ((mix(random) >> np.uint64(32)) * np.uint64(slots - rank) >> np.uint64(32)).astype(np.int64)
        if places is None:
            slot = pick
        else:
            at = np.arange(len(hashes))
            slot = places[at, pick].astype(np.int64)
            places[at, pick] = places[at, rank]
        np.minimum.at(out, rows * slots + slot, np.uint64(rank << 56) | (random >> np.uint64(8)))
        open_rows = (out.reshape(count, slots) == empty).any(axis=1)
        stay = open_rows[rows]
        if not stay.any():
            break
        if not stay.all() or places is None:
            hashes, rows, pick = hashes[stay], rows[stay], pick[stay]
            if places is None:
                places = np.tile(np.arange(slots, dtype=np.uint8), (len(hashes), 1))
                places[np.arange(len(hashes)), pick] = 0
            else:
                places = places[stay]
    return out.reshape(count, slots)


def shingles(texts: Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each row, sorted within rows, and their rows."""
    words = texts.word_hashes(texts.lower())
    rows = texts.word_rows()
    at = np.flatnonzero(texts.windows(size))
    hashes, of = rolling(words, size)[at] if len(at) else np.zeros(0, np.uint64), rows[at]
    short = np.flatnonzero((texts.counts > 0) & (texts.counts < size))
    for n in range(1, size):
        few = short[texts.counts[short] == n]
        if len(few):
            hashes = np.concatenate([hashes, rolling(words, n)[texts.first[few]]])
            of = np.concatenate([of, few])
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    return hashes[new], of[new]


def signed(docs: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = Texts(batch.column(1))
            hashes, rows = shingles(texts, size)
            counts = np.bincount(rows, minlength=texts.rows)
            bounds = np.concatenate([[0], np.cumsum(counts)])
            signature = super_minhash(hashes, rows, texts.rows, BANDS * ROWS)
            keys = np.zeros((texts.rows, BANDS), np.uint64)
            for row in range(ROWS):
                keys = mix(keys * np.uint64(0xD1B54A32D192ED03) + signature[:, row::ROWS])
            keys = mix(keys + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
            data = [hashes[i:j].tobytes() for i, j in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(counts, pa.int64()),
                    pa.array([hashlib.blake2b(d, digest_size=16).digest() for d in data], pa.binary()),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(texts.rows + 1) * BANDS, pa.int32()), pa.array(keys.ravel())
                    ),
                ],
                ["doc_id", "row", "n_shingles", "digest", "bands"],
            )

    return docs.select("doc_id", "text", row_key().alias("row")).mapInArrow(run, SIGNED)


def shingle_sets(texts_of: DataFrame, size: int) -> DataFrame:
    """The set of each class ``x``, from a ``text`` of it; repeated rows give it once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = Texts(batch.column(1))
            hashes, rows = shingles(texts, size)
            bounds = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=texts.rows))])
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["x", "shingles"])

    return texts_of.select("x", "text").mapInArrow(run, SETS).dropDuplicates(["x"])


def stars(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Sizes, link and symmetric difference of every pair ``c, x``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for c, x, centre, member in zip(*batch.columns, strict=True):
                a, b = np.asarray(centre.values), np.asarray(member.values)
                apart = np.setxor1d(a, b, assume_unique=True)
                linked = (100 + percent) * len(apart) <= (100 - percent) * (len(a) + len(b))
                out.append((c.as_py(), x.as_py(), len(a), len(b), linked, apart))
            types = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int64())]
            names = ["c", "x", "n_c", "n_x", "linked", "apart"]
            columns = zip(*out, strict=True) if out else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    # Both sides are plain scans, so a centre with many members can be split between tasks.
    of_x = sets.select("x", F.col("shingles").alias("sx"))
    of_c = sets.select(F.col("x").alias("c"), F.col("shingles").alias("sc"))
    return pairs.join(of_x, "x").join(of_c, "c").select("c", "x", "sc", "sx").mapInArrow(run, STARS)


def bucket_stars(members: DataFrame) -> DataFrame:
    """``c, x``: every member of each bucket (``bucket``, ``x``) with its centre.

    The centre meets the most members over all its buckets, the smallest one of these: a text that few others are near
    would leave the links of a large bucket to the search for further pairs.
    """
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n"), F.min("x").alias("least"), F.max("x").alias("last"))
    shared = members.join(sizes.where("least < last").select("bucket", "n"), "bucket")
    shared = files.materialize(shared, "shared-buckets")
    met = shared.groupBy("x").agg((-F.sum("n")).alias("met"))
    centres = shared.join(met, "x").groupBy("bucket").agg(F.min(F.struct("met", "x")).alias("first"))
    pairs = shared.join(centres.select("bucket", F.col("first.x").alias("c")), "bucket")
    return pairs.where("x <> c").select("c", "x").distinct()


def further_pairs(compared: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """``c, x``: pairs of members of a star that may be linked although not both are linked to its centre.

    With ``d`` the symmetric difference of two sets and ``s`` the sum of their sizes, a link is
    ``d <= share * s``. A pair (a, b) around a centre c has ``d = |Da| + |Db| - 2 overlap`` for the differences
    D from c. If a is not linked to c, a link of the pair needs an overlap of more than
    ``(|Db| + share * (|c| - |b|)) / 2`` (so the index prefix of b is long enough), and of at least
    ``(|Da| - share * (|a| + |c|)) / (1 + share)`` (the probe prefix of a).
    """
    share = (100 - percent) / (100 + percent)
    of_x = labels.select(F.col("node").alias("x"), F.col("component").alias("of_x"))
    of_c = labels.select(F.col("node").alias("c"), F.col("component").alias("of_c"))
    star = compared.join(of_x, "x", "left").join(of_c, "c", "left")
    star = star.withColumns({"of_x": F.coalesce("of_x", "x"), "of_c": F.coalesce("of_c", "c"), "d": F.size("apart")})
    open_stars = star.where("NOT linked AND of_x <> of_c").select("c").distinct()
    star = star.join(open_stars, "c")
    least = F.floor((F.col("d") + share * (F.col("n_c") - F.col("n_x"))) / 2 - 1e-9)
    excess = F.col("d") - share * (F.col("n_c") + F.col("n_x"))
    probe = F.col("d") + 1 - F.greatest(F.lit(1), F.ceil(excess / (1 + share) - 1e-9))
    star = star.withColumns(
        {
            "index": F.least(F.col("d"), F.col("d") - least),
            "probe": F.when(F.expr("NOT linked AND of_x <> of_c"), probe).otherwise(0),
        }
    )
    rows = star.select("c", "x", "n_x", "of_x", "d", "index", "probe", F.explode("apart").alias("shingle"))
    counts = rows.groupBy("c", "shingle").agg(F.count("*").alias("n"))
    rows = rows.join(counts, ["c", "shingle"])
    place = Window.partitionBy("c", "x").orderBy("n", "shingle")
    rows = rows.withColumn("at", F.row_number().over(place)).where("n > 1 AND at <= greatest(index, probe)")
    a = rows.where("at <= probe").select("c", "shingle", *[F.col(k).alias(f"a_{k}") for k in ("x", "n_x", "of_x", "d", "at")])
    b = rows.where("at <= index").select("c", "shingle", *[F.col(k).alias(f"b_{k}") for k in ("x", "n_x", "of_x", "d", "at")])
    met = a.join(b, ["c", "shingle"]).where("a_of_x <> b_of_x")
    met = met.where(f"100 * least(a_n_x, b_n_x) >= {percent} * greatest(a_n_x, b_n_x)")
    met = met.where(
        f"1 + least(a_d - a_at, b_d - b_at) >= (a_d + b_d - {share!r} * (a_n_x + b_n_x)) / 2 - 1e-9"
    )
    return met.select(F.least("a_x", "b_x").alias("c"), F.greatest("a_x", "b_x").alias("x")).distinct()


def groups(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, stays, row`` for each row of ``docs`` (``doc_id``, ``text``).

    Documents are linked if their sets of ``shingle``-word shingles have a Jaccard similarity of at least
    ``percent`` per cent; the smallest ``doc_id`` of a component is its name and ``kept``. ``stays`` holds for one
    pair of id and text of each component (also where ids repeat or are missing); ``row`` is the key of the pair.
    """
    marked = files.materialize(signed(docs, shingle), "signatures")
    named = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
    classes = marked.where("n_shingles > 0").groupBy(F.col("digest").alias("x")).agg(
        F.min(named).alias("first"), F.any_value("bands").alias("bands")
    )
    classes = files.materialize(classes, "classes")
    pairs = files.materialize(bucket_stars(classes.select("x", F.explode("bands").alias("bucket"))), "pairs")
    met = pairs.select("x").union(pairs.select("c")).distinct()
    wanted = classes.select("x", F.col("first.row").alias("row")).join(met, "x")
    # The keys grow with the corpus, so the join is planned alike at every size.
    texts = docs.select(row_key().alias("row"), "text").join(wanted.hint("merge"), "row")
    sets = files.materialize(shingle_sets(texts, shingle), "sets")
    compared = files.materialize(stars(pairs, sets, percent), "stars")
    labels = components(compared.where("linked").select(F.col("c").alias("a"), F.col("x").alias("b")))
    pairs = files.materialize(further_pairs(compared, labels, percent), "pairs")
    links = stars(pairs, sets, percent).where("linked").select(F.col("c").alias("a"), F.col("x").alias("b"))
    links = files.materialize(links, "links")
    if not links.isEmpty():
        labels = components(links.union(labels.select("node", "component")))
    linked = labels.select(F.col("node").alias("x"), "component").join(classes.select("x", "first"), "x")
    firsts = linked.groupBy("component").agg(F.min("first").alias("of_all"))
    firsts = linked.join(firsts, "component").select("x", "of_all")
    of_class = classes.select("x", "first").join(firsts, "x", "left")
    of_class = of_class.select(F.col("x").alias("digest"), F.coalesce("of_all", "first").alias("first"))
    of_class = files.materialize(of_class, "named")  # plain scans again: copies of one text may be split
    found = marked.select("doc_id", "row", "n_shingles", "digest").join(of_class, "digest", "left")
    component = F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id"))
    stays = F.col("first").isNull() | (F.col("first.row") == F.col("row"))
    return found.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, stays).alias("kept"),
        stays.alias("stays"),
        "row",
    )
