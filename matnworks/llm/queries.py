"""The registered queries of this subpackage and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matnworks.llm import (
    alignment,
    chat,
    classifier,
    decontamination,
    extraction,
    lines,
    neardup,
    neighbours,
    packing,
    passages,
    pii,
    quality,
    repair,
)
from matnworks.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@query("op2_quality_rules")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measure(table(spark, sf_dir, "documents"))


def tokenizer() -> tuple[str, str, str]:
    """The byte-level vocabulary as a tokenizer file and as ranks, and the pattern that splits text."""
    import public_tokenizers

    return (
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


@query("op5_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), *tokenizer())


@query("op8_minhash_near_dedup")
def minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.groups(table(spark, sf_dir, "documents"), shingle=4)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op1_substring_dedup")
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = passages.deduplicate(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


DECONTAMINATION_SQL = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
    SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS t
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
spots AS (
    SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS t
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
found AS (SELECT s.doc_id, s.i, s.n, x.item_id FROM spots s JOIN windows x ON s.t = x.t AND s.n = x.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
    FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query("op4_benchmark_decontamination", DECONTAMINATION_SQL)
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


WHITE_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LINE_SQL = rf"""
WITH l AS (
    SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
    FROM documents WHERE text IS NOT NULL),
bare AS (SELECT *, trim(line, {WHITE_SQL}) AS b FROM l),
counts AS (SELECT source, b AS k, count(DISTINCT text) AS n FROM bare WHERE b <> '' GROUP BY 1, 2),
totals AS (SELECT source, count(DISTINCT text) AS total FROM documents WHERE text IS NOT NULL GROUP BY 1),
bad AS (SELECT c.source, k FROM counts c JOIN totals t ON c.source IS NOT DISTINCT FROM t.source WHERE n >= 2 AND n > 0.1 * total),
kept AS (
    SELECT doc_id, count(*) FILTER (b <> '') AS n_lines,
        count(*) FILTER (k IS NOT NULL) AS n_dropped, string_agg(line, chr(10) ORDER BY i) FILTER (k IS NULL) AS text
    FROM bare LEFT JOIN bad ON bare.source IS NOT DISTINCT FROM bad.source AND b = k GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped,
    CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(kept.text, '')) END AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id)
"""


@query("op10_line_dedup", LINE_SQL)
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.drop_boilerplate(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op3_chat_formatting")
def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("</s>[INST] ok [/INST]")
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        said.alias("text"),
    )
    return chat.read_back(chat.format_chat(chat.records(rows.union(added), chat.MAPPINGS)))


@query("op6_quality_classifier")
def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = (F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1).alias("held_out")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"), held_out)
    weights = classifier.fit(docs, labels.where("NOT held_out").select("doc_id", "label"))
    scored = classifier.score(docs, weights)
    return scored.select("doc_id", held_out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op9_pii_random_field")
def pii_random_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"), pii.train())
    counts = [f"n_{kind}" for kind in pii.BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans")


@query("op7_html_extraction")
def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


def damaged(rows: DataFrame) -> DataFrame:
    """The damage that the contract of op12 states: five of twenty parts of the rows get one fault each."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat(shown[0], F.lit(":"), shown[1]).cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    hurt = rows.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"),
    )
    return hurt.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).drop("copies", "copy")


@query("op12_conversation_repair")
def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    reports = repair.repair(damaged(rows)).reports().withColumnRenamed("conv_id", "c")
    found = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().join(
        reports, F.col("conv_id").eqNullSafe(F.col("c")), "left"
    )
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return found.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


@query("op11_pruned_graph_neighbours")
def pruned_graph_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    index = neighbours.build(rows, "embedding", k=5)
    return neighbours.neighbours(index, rows.where("vec_id % 50 = 0"), "embedding", k=5)


@query("op13_cross_tokenizer_alignment")
def cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    _, ranks, pattern = tokenizer()
    pair = alignment.Aligner(ranks, pattern, public_tokenizers.path("piece_bpe_32k.model"))
    return pair.align(table(spark, sf_dir, "documents"))
