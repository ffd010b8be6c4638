"""Token alignment against a brute force that reads the contract word for word."""

from __future__ import annotations

import hashlib
import json
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from watchpost.llm.queries import op12_token_alignment
from watchpost.llm.token_alignment import (
    TOKENIZERS,
    Aligned,
    Encoders,
    Vocabularies,
    align_tokens,
    aligned_documents,
    byte_of_letter,
    groups,
)


@cache
def encoders():
    return Encoders(Vocabularies.read())


@cache
def libraries():
    a = Tokenizer.from_file(f"{TOKENIZERS}/byte_bpe_50k.json")
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=f"{TOKENIZERS}/piece_bpe_32k.model")


def brute_groups(text):
    """Groups of (A ids, B ids); the tokens come from the libraries of the files."""
    if not text:
        return []
    a, b = libraries()
    letters = byte_of_letter()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [
        bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
        for i in ids_b
    ]
    whole = (" " + text).encode()
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return []
    ends_a, ends_b = np.cumsum(list(map(len, bytes_a))).tolist(), np.cumsum(list(map(len, bytes_b))).tolist()
    out, i, j = [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        x, y = ends_a.index(end) + 1, ends_b.index(end) + 1
        out.append((ids_a[i:x], ids_b[j:y]))
        i, j = x, y
    return out


def brute(texts):
    """Rows without the id, in order."""
    per_text = [brute_groups(t) for t in texts]
    links = [Counter((a, b) for x, y in g for a in x for b in y) for g in per_text]
    counts = Counter(pair for own in links for pair in own)
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    rows = []
    for g, own in zip(per_text, links):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        rows.append((
            sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(own.values()), text,
            sum(m for p, m in own.items() if counts[p] == most[p[0]]), sum(m * counts[p] for p, m in own.items()),
        ))
    return rows


TEXTS = [
    "Plain words, and 12345 numbers.", "Plain words again", "", None, " ", "x", "  two  spaces\n\n\tand tabs ",
    "naïve café – Straße 日本語のテキスト 😀😀", "▁ is a space to one of them", "<|endoftext|> <s> </s> <unk> <0x41> [CLS]",
    "a" * 3000, "= " * 500, "ab" * 700 + "!" * 77, "Plain words again", "nul\x00inside\x7f", "aaaa bbbb " * 40,
    "don't can't I'LL we've", "﻿bom", "0x" + "deadbeef" * 60,
]


def compare(spark, documents, texts, ids=None, **options):
    found = align_tokens(documents(texts, ids), **options)
    expected = brute(texts)
    ids = list(range(len(texts))) if ids is None else ids
    assert Counter(map(tuple, found.collect())) == Counter((i, *row) for i, row in zip(ids, expected))


def test_equals_brute_force(spark, documents):
    compare(spark, documents, TEXTS)


def test_beyond_the_broadcast(spark, documents):
    compare(spark, documents, TEXTS * 3, broadcast_pairs=0)


def test_repeated_rows_and_null_ids(spark, documents):
    texts = ["one two three", "one two three", "four one", "four one", "one"] + ["hot copy of words"] * 20
    compare(spark, documents, texts, [7, 7, None, None, 3] + [9] * 20)


def test_empty_table_and_clashing_columns(spark, documents):
    assert align_tokens(documents([])).collect() == []
    rows = [(1, "some words", 5, [1], 2, "x")]
    table = spark.createDataFrame(rows, "doc_id long, text string, row int, pairs array<int>, n_a int, id string")
    assert tuple(align_tokens(table).first()) == (1, *brute(["some words"])[0])


def test_query_over_the_smallest_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    expected = Counter()
    for d, (n_a, n_b, n_groups, n_links, text, n_best, total) in zip(docs, brute([d.text for d in docs])):
        digest = text and hashlib.sha256(text.encode()).hexdigest()
        expected[d.doc_id, n_a, n_b, n_groups, n_links, n_best, total, digest] += 1
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    found = op12_token_alignment(spark, sf_dir)
    assert sorted(found.columns) == sorted(columns)
    assert Counter(map(tuple, found.select(columns).collect())) == expected


def test_groups_text_joins_to_the_tokens(spark, documents):
    row = aligned_documents(documents(["Quite some words, here: 日本"])).first()
    expected = brute_groups("Quite some words, here: 日本")
    assert row.groups == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in expected)
    assert len(row.pairs) == len(set(row.pairs)) and sum(row.links) == row.n_links


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sets(st.integers(1, 39)), st.sets(st.integers(1, 39))), min_size=1, max_size=6))
def test_halving_finds_all_common_ends(documents):
    a, b, first_a, first_b, expected = [0], [0], [0], [0], []
    for k, (x, y) in enumerate(documents):
        x, y = sorted(x | {40}), sorted(y | {40})
        a += [40 * k + e for e in x]
        b += [40 * k + e for e in y]
        first_a.append(len(a) - 1)
        first_b.append(len(b) - 1)
        expected += [40 * k + e for e in sorted(set(x) & set(y))]
    a, b = np.array(a), np.array(b)
    ends_a, ends_b = groups(a, b, np.array(first_a), np.array(first_b))
    assert a[ends_a].tolist() == expected == b[ends_b].tolist()


def test_large_groups_are_linked_by_different_ids():
    found = Aligned.of(encoders(), ["a" * 4000, "b c"])
    _, pairs, links = found.pairs(32000)
    size_a, size_b = found.sizes
    assert links.sum() == (size_a * size_b).sum() and len(pairs) < 40


@pytest.mark.parametrize("unit", ["a", "ab ", "é", "word ", "日"])
def test_time_is_about_linear_in_one_text(unit):
    from time import perf_counter

    def took(n):
        started = perf_counter()
        found = Aligned.of(encoders(), [unit * n])
        found.pairs(32000)
        return perf_counter() - started

    took(1000)
    assert took(400_000) < 10 * max(took(100_000), 0.1)


def test_merges_out_of_order_are_refused():
    from watchpost.llm.token_alignment import byte_ranks

    vocabulary = {"a": 0, "b": 1, "ab": 3, "ba": 2}
    model = {"vocab": vocabulary, "merges": ["a b", "b a"]}
    with pytest.raises(ValueError, match="order"):
        byte_ranks(json.dumps({"model": model}).encode())
