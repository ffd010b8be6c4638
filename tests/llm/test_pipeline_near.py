"""The pipeline's near-duplicate stage on hand-written rows, against all pairs at its own width and threshold."""

from __future__ import annotations

import random

import pytest
from brute import spaced_words

import corpus_pipeline


def shingles(text, width=5):
    words = spaced_words(text, lower=True)
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute_kept(rows, percent=80):
    """Positions of the first row of each component, by comparing all pairs; ids are different."""
    sets = [shingles(text) for _, text in rows]
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
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return sorted(least.values())


def words(prefix, n=1000):
    return [f"{prefix}{i}" for i in range(n)]


def replaced(text, k):
    """``k`` words in even distances are others."""
    return [f"y{i}" if i % (len(text) // k) == 20 and i // (len(text) // k) < k else w for i, w in enumerate(text)]


@pytest.fixture
def kept(spark, documents):
    def run(texts, ids):
        docs = documents(texts, ids)
        rows = corpus_pipeline.near_duplicates(spark, docs, "").collect()
        return sorted(((r["doc_id"], r["text"]) for r in rows), key=str)

    return run


def test_copies_of_five_words_and_four_fifths_go(kept):
    a, b, c = words("a"), words("b"), words("c")
    rng = random.Random(1)
    texts = [a, a[:830], b, replaced(b, 22), c, c[:790], words("d", 60), [*words("d", 52), *words("e", 8)]]
    texts += [[rng.choice("uvwxyz") + str(rng.randrange(90)) for _ in range(200)] for _ in range(4)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    found = sorted(d for d, _ in kept([t for _, t in rows], [d for d, _ in rows]))
    assert found == brute_kept(rows)
    assert {1, 3} & set(found) == set() and 5 in found


def test_rows_without_id_are_copies_too(kept):
    a, b = " ".join(words("a", 80)), " ".join(words("b", 80))
    found = kept([a, a + " end", a, b, b, b + " end", "", ""], [7, *[None] * 7])
    assert [r for r in found if r[1] in ("", a)] == [(7, a), (None, ""), (None, "")] and len(found) == 4
    assert [r[1] in (b, b + " end") for r in found].count(True) == 1


def test_rows_that_share_an_id_are_judged_by_their_text(kept):
    a, b, c = (" ".join(words(p, 80)) for p in "abc")
    assert kept([a, b], [5, 5]) == [(5, a), (5, b)]
    assert kept([a, a + " end", c], [2, 5, 5]) == [(2, a), (5, c)]
    assert kept([a, a, a], [5, 5, 5]) == [(5, a)]
