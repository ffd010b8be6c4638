from __future__ import annotations

import random

import numpy as np
import pytest
from brute import spaced_words
from pyspark.sql import functions as F

from watchpost.llm import jaccard_join as jj


def shingle_set(text, width):
    words = spaced_words(text, lower=True)
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute_components(rows, width=4, percent=85):
    """By comparing all pairs: ``{position: (size, component)}``."""
    sets = [shingle_set(text, width) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    names = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            names[root(i)] = min(doc_id, names.get(root(i), doc_id))
    return sorted(((d, len(sets[i]), names.get(root(i))) for i, (d, _) in enumerate(rows)), key=str)


def answer(docs):
    rows = jj.jaccard_components(docs).select("doc_id", "n_shingles", "component_id").collect()
    return sorted(map(tuple, rows), key=str)


def edited(words, changes, rng):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def mixed_texts(seed):
    """Small and large sets, exact and near copies, and a passage that all share."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for size in (4, 7, 9, 12, 20, 30, 45, 80, 200):
        for _ in range(2):
            base = [rng.choice(vocabulary) for _ in range(size)]
            texts.append(" ".join(base))
            texts += [edited(base, k % 3, rng) for k in range(6)]
            texts.append(" ".join(base).upper())
    shared = " ".join(rng.choice(vocabulary) for _ in range(25))
    texts += [shared + " " + " ".join(rng.choice(vocabulary) for _ in range(10 + k)) for k in range(30)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("block", [512, 5])
def test_components_equal_all_pairs(spark, documents, monkeypatch, block):
    monkeypatch.setattr(jj, "BLOCK", block)
    texts = mixed_texts(block)
    rows = list(enumerate(texts))
    assert answer(documents(texts)) == brute_components(rows)


def test_table_equals_all_pairs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert answer(docs) == brute_components(rows)


def test_edge_cases(spark, documents):
    long = " ".join(f"v{i % 977}" for i in range(60_000))
    texts = [None, "", " \n\t", "a b", "A  B", "a b c", long, long + " end", "q w e r t y u", "q w e r t y u", None]
    ids = [5, 4, 3, 2, 9, 1, 8, 7, None, None, None]
    docs = documents(texts, ids).withColumn("component_id", F.lit("own")).withColumn("n", F.lit(0))
    assert answer(docs) == brute_components(list(zip(ids, texts)))
    assert answer(documents([])) == []


def test_repeated_rows_are_one_component_and_one_stays(spark, documents):
    texts = ["a b c d e f"] * 3 + ["a b c d e f", "other words are here now", "no id", "no id"]
    docs = documents(texts, [1, 1, 1, 2, 3, None, None]).withColumn("__rows", F.lit(1)).drop("__rows")
    assert [r[2] for r in answer(docs)] == [1, 1, 1, 1, 3, None, None]
    kept = jj.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [1, 3, None, None]


def test_similar_sets_share_enough_of_their_prefixes():
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(6, 120))
        a = rng.choice(10**6, n, replace=False)
        b = np.r_[a[int(rng.integers(0, n // 6 + 1)) :], rng.choice(10**6, int(rng.integers(0, 3))) + 10**7]
        a, b = set(a.tolist()), set(b.tolist())
        if 100 * len(a & b) < 85 * len(a | b):
            continue
        prefix = [set(sorted(s)[: jj.prefix_length(len(s), 85)]) for s in (a, b)]
        assert len(prefix[0] & prefix[1]) >= jj.prefix_overlap(len(a), len(b), 85)


def test_boundary_is_where_enumerating_costs_more_than_lists(spark):
    def members(size, copies):
        rows = [(i, size, [1000 * k for k in range(jj.prefix_length(size, 85))]) for i in range(copies)]
        return spark.createDataFrame(rows, "node long, n long, prefix array<long>")

    # 40 equal prefixes make lists of 40 rows for each; subsets are 20 rows a set.
    assert jj.light_boundary(members(20, 40), 85) == 20
    # Single sets read only themselves.
    assert jj.light_boundary(members(40, 1), 85) == 0


def test_shared_counts():
    sets = [np.array(x, np.int64) for x in ([1, 2, 3], [2, 3, 4], [9], [])]
    assert jj.shared_counts(sets).tolist() == [[0, 2, 0, 0], [2, 0, 0, 0], [0, 0, 0, 0], [0, 0, 0, 0]]
