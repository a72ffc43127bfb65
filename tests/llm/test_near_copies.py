"""Large groups of near copies: the pairs that are compared, and the links."""

import random

from pyspark.sql import functions as F

from matnworks.llm import neardup
from matnworks.llm.components import components
from matnworks.llm.rows import row_key
from test_against_brute_force import by_id


def test_a_large_group_of_near_copies_is_compared_with_a_near_centre(spark):
    """Pairs beyond the stars stay fewer than the members, whichever member has the smallest digest."""
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(20000)]
    base = [r.choice(vocabulary) for _ in range(150)]
    rows = []
    for i in range(400):
        copy = list(base)
        for p in r.sample(range(len(copy)), i % 6):
            copy[p] = r.choice(vocabulary)
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    members = neardup.signed(docs, 5).select(F.col("digest").alias("x"), F.explode("bands").alias("bucket")).distinct()
    texts = neardup.signed(docs, 5).select(F.col("digest").alias("x"), "row").join(
        docs.select(row_key().alias("row"), "text"), "row"
    )
    sets = neardup.shingle_sets(texts, 5).cache()
    compared = neardup.stars(neardup.bucket_stars(members), sets, 80).cache()
    labels = components(compared.where("linked").select(F.col("c").alias("a"), F.col("x").alias("b")))
    assert neardup.further_pairs(compared, labels, 80).count() < sets.count()
    own = {i: {tuple(t.split()[p : p + 5]) for p in range(146)} for i, t in rows}
    label = {i: i for i in own}
    for a in own:
        for b in own:
            if label[a] != label[b] and 100 * len(own[a] & own[b]) >= 80 * len(own[a] | own[b]):
                low, high = sorted((label[a], label[b]))
                label = {k: low if v == high else v for k, v in label.items()}
    assert {i: c for i, (c,) in by_id(neardup.groups(docs, shingle=5), "component_id").items()} == label
    assert 100 < list(label.values()).count(0) < 400
