"""Alignment of two tokenizers against whole texts encoded by both libraries."""

import functools
import hashlib
from collections import Counter

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from matnworks.llm import alignment, queries

GIVEN = (P.path("byte_bpe_50k.tiktoken"), P.PATTERN, P.path("piece_bpe_32k.model"))


@functools.cache
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in keep} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in keep)}
    return a, b, letters


def plain(text):
    """The groups of a text as pairs of id lists."""
    a, b, letters = libraries()
    if not text:
        return []
    left = a.encode(" " + text, add_special_tokens=False).ids
    right = b.encode(text)
    bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in left]
    bytes_b = [
        bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in right
    ]
    data = (" " + text).encode()
    if b"".join(bytes_a) != data or b"".join(bytes_b) != data:
        return []
    ends = []
    for parts in (bytes_a, bytes_b):
        at, out = 0, []
        for x in parts:
            at += len(x)
            out.append(at)
        ends.append(out)
    common = sorted(set(ends[0]) & set(ends[1]))
    groups, x, y = [], 0, 0
    for c in common:
        i, j = ends[0].index(c, x) + 1, ends[1].index(c, y) + 1
        groups.append((left[x:i], right[y:j]))
        x, y = i, j
    return groups


def expected(rows):
    groups = [(doc_id, plain(text)) for doc_id, text in rows]
    counts = Counter((a[-1], b[-1]) for _, found in groups for a, b in found)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for doc_id, found in groups:
        linked = [(a[-1], b[-1]) for a, b in found]
        shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in found)
        out.append(
            (
                doc_id, sum(len(a) for a, _ in found), sum(len(b) for _, b in found), len(found), len(linked),
                sum(counts[x] == most[x[1]] for x in linked), sum(counts[x] for x in linked),
                hashlib.sha256(shown.encode()).hexdigest() if found else "",
            )
        )
    return sorted(out, key=repr)


ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "x\n y\n\n z \n", "\n\n", "tab\t and \r\n more", "▁", "foo ▁bar",
    "<|endoftext|> and <s> [INST] <0x41>", "naïve café, it's we'll 日本語テキスト 世界 مرحبا بكم", "zero\0byte \0 end\0", "a\xa0b \xa0c",
    "😀😀 👩‍👩‍👧 é", "1234567 89,000.50 --- ===", "x" * 300, "ab" * 200 + " " + "word " * 50, "　 wide   x", "\x1c x \x85 y",
    "a\n\n b", "  lead", "trail\n\n", "’s don’t", "﻿bom x", "ﬁ ① ａ", "日本" * 400, "same words same words", "same words same words",
]


def found_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("chunk", [7, 64, 1 << 16])
def test_alignment_of_odd_texts_with_chunks_of_any_size(spark, chunk):
    rows = [(i if i % 9 else None, t) for i, t in enumerate(ODD)] + [(3, "one id"), (3, "two texts")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"part": F.lit("x"), "links": F.lit(1), "n_a": F.lit(9)})
    assert found_rows(alignment.Aligner(*GIVEN, chunk=chunk).align(df)) == expected(rows)


def test_alignment_of_the_given_documents(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = expected(rows)
    assert found_rows(queries.QUERIES["op13_cross_tokenizer_alignment"](spark, sf_dir)) == want
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert found_rows(alignment.Aligner(*GIVEN, chunk=500).align(docs)) == want


def test_long_documents_are_cut_and_composed_by_rounds(spark):
    text = ("Une naïve phrase, longue de quelques mots\n" * 40 + "日本語" * 30) * 8
    rows = [(1, text), (2, text[5:]), (3, "no gap" + "x" * 9000 + " " + "▁" + text), (4, "short")]
    pair = alignment.Aligner(*GIVEN, chunk=100)
    fragments = pair.fragments(spark.createDataFrame(rows[:3], "doc_id long, text string"))
    assert fragments.agg(F.max("chunk")).first()[0] > alignment.FAN**2
    assert fragments.where("size(head_a) > 1 AND size(tail_a) > 0").count() > 10
    assert found_rows(pair.align(spark.createDataFrame(rows, "doc_id long, text string"))) == expected(rows)


@pytest.mark.parametrize("size", [2, 5, 9, 13])
def test_fragments_compose_in_any_order(size):
    tokens = alignment.Tokens(*GIVEN)
    data = b" " + ("interoperability überprüfen 日本語 naïveté counterintuitive misunderstanding " * 5).encode()
    parts = []
    for begin, start, stop, end in alignment.ranges(data, size):
        valid, part, *_ = tokens.fragment(data[begin:end], begin, start, stop)
        assert valid
        parts.append(part)
    assert len(parts) > 20 and (size != 9 or any(p.n_groups == 0 and (p.head_a or p.head_b) for p in parts))
    left = functools.reduce(alignment.Fragment.then, parts, alignment.EMPTY)
    right = functools.reduce(lambda x, y: y.then(x), parts[::-1], alignment.EMPTY)
    middle = functools.reduce(
        alignment.Fragment.then, [a.then(b) for a, b in zip(parts[::2], [*parts[1::2], alignment.EMPTY], strict=False)]
    )
    assert left == right == middle
    assert left.groups() == ";".join(alignment.shown(a, b) for a, b in plain(data.decode()[1:]))


def test_ranges_cover_the_text_and_stay_short():
    for data in (b" " + b"x" * 5000, b" a" * 3000, b" " + b"x" * 990 + b" y" * 20 + b"z" * 3000 + b" end", b" ", b"  a"):
        found = list(alignment.ranges(data, 100))
        assert [s for _, s, _, _ in found] == [0, *(e for _, _, e, _ in found[:-1])] and found[-1][2] == len(data)
        assert all(b <= s < e <= end for b, s, e, end in found)
        assert all(s - b <= 100 and end - e <= 100 for b, s, e, end in found)


def test_empty_table_and_bound_of_pairs(spark):
    assert alignment.Aligner(*GIVEN).align(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert alignment.Tokens(*GIVEN).bound() < 600_000
