"""The recurrent language model: counts and base scores against brute force, the network against
plain formulas and numeric gradients, and held-out accuracy."""

from __future__ import annotations

import math
import random
import resource
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from brute import spaced_words

from watchpost.llm.queries import op11_recurrent_scores
from watchpost.llm.recurrent_lm import Settings, Vocabulary, _symbols, count_words, encoded, score_documents
from watchpost.llm.recurrent_net import Network, Trainer, add_by_symbol, class_edges, lanes, score
from watchpost.llm.storage import shared_value
from watchpost.llm.words import hash_words

SMALL = Settings(symbols=20, lookup=40, hidden=8, classes=4, rounds=2, segment=16, lanes=8, steps=8)


def is_held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def brute(rows):
    """``(id, held_out, n_tokens, n_known, train_tokens)`` and the base score, from the contract."""
    tokens = [[*spaced_words(text, lower=True), None] for _, text in rows]
    counts = Counter(t for (i, _), own in zip(rows, tokens) if not is_held_out(i) for t in own)
    n, v = sum(counts.values()), len(counts)
    out = []
    for (i, _), own in zip(rows, tokens):
        base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in own)
        out.append(((i, is_held_out(i), len(own), sum(counts[t] > 0 for t in own), n), base))
    return out


def check(spark, rows, settings=SMALL, schema="doc_id long, text string"):
    found = score_documents(spark.createDataFrame(rows, schema), settings=settings).collect()
    key = lambda x: (x[0][0] is None, x)
    ours = sorted(((tuple(r)[:5], r.base_score) for r in found), key=key)
    theirs = sorted(brute([r[:2] for r in rows]), key=key)
    assert [x for x, _ in ours] == [x for x, _ in theirs]
    assert np.allclose([x for _, x in ours], [x for _, x in theirs], rtol=1e-9, atol=1e-9)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in found)
    return found


def prose(n, seed=0):
    """Two languages, each with an order of its own."""
    draw = random.Random(seed)
    tongues = [[f"{a}{b}" for b in "aeiou"] for a in ("k", "m")]
    rows = []
    for i in range(n):
        words, at = draw.choice(tongues), 0
        text = []
        for _ in range(draw.randrange(5, 60)):
            at = (at + draw.choice((1, 1, 1, 2))) % 5
            text.append(words[at])
        rows.append((i, " ".join(text)))
    return rows


def test_counts_and_base_scores(spark):
    rows = prose(60) + [(1000, "Rare WORDS once, ÄÖ once"), (1001, "rare words\tagain\n\x0b\x0c\rend")]
    check(spark, rows)


def test_held_out_texts_are_better_predicted_than_by_frequency(spark):
    settings = Settings(symbols=20, hidden=8, classes=4, rounds=2, segment=32, lanes=16, steps=16, rate=0.02)
    found = check(spark, prose(4000), settings)
    held = [r for r in found if r.held_out]
    assert len(held) > 40
    per_token = lambda c: sum(r[c] for r in held) / sum(r.n_tokens for r in held)
    assert per_token("score") > per_token("base_score") + 0.3


def test_over_the_smallest_table(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = {r.doc_id: r for r in op11_recurrent_scores(spark, sf_dir).collect()}
    for (i, held, n, known, train), base in brute(docs):
        r = found[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, train)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    held = [r for r in found.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_edge_cases(spark):
    rows = prose(20) + [(100, None), (101, ""), (102, " \n "), (None, "ka ke"), (None, None), (3, "ka ke"), (3, "ka ke"),
                        (103, "x" * 5000), (104, "ka " * 9000)]
    found = check(spark, rows)
    same = [r for r in found if r.id == 3 and r.n_tokens == 3]
    assert len(same) == 2 and same[0] == same[1]
    assert check(spark, []) == []


def test_batches_without_words(spark):
    rows = [(i, None if i % 2 else " ") for i in range(40)]
    found = score_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), settings=SMALL)
    assert sorted((r.id, r.n_tokens) for r in found.collect()) == [(i, 1) for i in range(40)]


def test_without_training_documents(spark):
    held = [i for i in range(200) if is_held_out(i)][:5]
    found = check(spark, [(i, "some words") for i in held])
    assert all(r.train_tokens == 0 and r.n_known == 0 for r in found)


def test_clashing_columns(spark):
    rows = [(i, t, 1, "x", True) for i, t in prose(20)]
    check(spark, rows, schema="doc_id long, text string, row int, symbols string, held_out boolean")


def test_one_source_document_is_a_third(spark):
    rows = prose(40) + [(500, "hot copy of the same words")] * 20
    check(spark, rows)


def test_counts_of_words(spark):
    table = spark.createDataFrame([(1, "A b a"), (2, "b"), (4, "c a")], "doc_id long, text string")
    expected = Counter(t for i, x in [(1, "a b a"), (2, "b"), (4, "c a")] if not is_held_out(i) for t in [*x.split(), None])
    assert {r.word: r.n for r in count_words(table).collect()} == expected


def network(symbols=7, hidden=3, classes=3, seed=5, noise=0.5):
    counts = np.arange(symbols, 0, -1).astype(float) ** 2
    made = Network.new(counts, 3.0, hidden=hidden, classes=classes, seed=seed)
    draw = np.random.default_rng(seed)
    return made.with_flat(made.flat() + draw.normal(0, noise, made.flat().size))


def plain_score(net, texts, first_input):
    """One text and one step at a time, in double precision."""
    w = {k: x.astype(float) for k, x in net.weights.items()}
    hidden, out = net.hidden, []
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    softmax = lambda x: np.exp(x) / np.exp(x).sum()
    for text in texts:
        state, before = np.zeros(hidden), first_input
        for s in text:
            x, u = w["inputs"][before], state @ w["states"]
            r, z = sigmoid(x[:hidden] + u[:hidden]), sigmoid(x[hidden : 2 * hidden] + u[hidden : 2 * hidden])
            candidate = np.tanh(x[2 * hidden :] + r * u[2 * hidden :])
            state = candidate + z * (state - candidate)
            c = net.class_of[s]
            p = softmax(w["classes"] @ state + w["class_bias"])[c]
            if c < len(net.edges) - 1:
                low, high = net.edges[c], net.edges[c + 1]
                p *= softmax(w["symbols"][low:high] @ state + w["symbol_bias"][low:high])[s - low]
            out.append(math.log(p))
            before = s
    return np.array(out)


def laid(texts):
    length = np.array([len(t) for t in texts])
    return np.concatenate([np.array(t, np.int64) for t in texts]), np.cumsum(length) - length, length


def test_network_scores_equal_plain_formulas():
    draw = random.Random(2)
    texts = [[draw.randrange(8) for _ in range(draw.choice((1, 2, 30, 700)))] for _ in range(40)]
    net = network()
    assert np.allclose(score(net, *laid(texts), 0), plain_score(net, texts, 0), atol=1e-4)


def test_probabilities_sum_to_one():
    net = network(symbols=30, classes=6)
    text = [3, 7, 30, 2]
    total = sum(math.exp(plain_score(net, [[*text, s]], 0)[-1]) for s in range(31))
    ours = sum(math.exp(score(net, *laid([[*text, s]]), 0)[-1]) for s in range(31))
    assert total == pytest.approx(1) and ours == pytest.approx(1, abs=1e-4)


def test_gradients_equal_differences():
    texts = [[1, 2, 7, 0, 3], [4, 4, 6]]
    net = network(noise=0.3)
    seen = {}

    class Spy(Trainer):
        def _update(self, gradients):
            seen.update(gradients)

    for group in lanes(*laid(texts), 8, 0):
        Spy(net, steps=8, rate=0.1).train(group)
    flat = np.concatenate([seen[k].ravel() for k in net.weights]).astype(float)
    values, step = net.flat().astype(float), 1e-2
    draw = np.random.default_rng(1)
    for i in draw.choice(len(values), 60, replace=False):
        loss = []
        for sign in (1, -1):
            moved = values.copy()
            moved[i] += sign * step
            loss.append(-plain_score(net.with_flat(moved), texts, 0).mean())
        assert flat[i] == pytest.approx((loss[0] - loss[1]) / (2 * step), abs=2e-3)


def test_classes_cover_all_symbols():
    for n, classes in ((1, 4), (5, 4), (3000, 45)):
        edges = class_edges(1e6 / (1 + np.arange(n)), classes)
        assert edges[0] == 0 and edges[-1] == n and (np.diff(edges) > 0).all() and len(edges) <= classes + 1


def test_training_keeps_its_memory_between_windows():
    draw = np.random.default_rng(3)
    net = Network.new(np.arange(2048, 0, -1) ** 2.0, 1e6, hidden=16, classes=45, seed=1)
    symbols = draw.integers(0, 2049, 512 * 320)
    (group,) = lanes(symbols, np.arange(512) * 320, np.full(512, 320), 512, 0)
    trainer = Trainer(net, steps=16, rate=0.01)
    trainer.train(group)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_minflt
    trainer.train(group)
    assert (resource.getrusage(resource.RUSAGE_SELF).ru_minflt - before) / 20 < 500  # pages a window


def test_documents_are_written_as_one_value_each(spark):
    texts = ["b a", None, "a rare A", "", "b " * 3000]
    table = spark.createDataFrame([(i + 1, x) for i, x in enumerate(texts)], "doc_id long, text string")
    counts = np.array([5.0, 4.0, 3.0])  # a, b, end
    known = np.array([b"a", b"b"])
    hashes = hash_words(list(known))
    order = np.argsort(hashes)
    vocabulary = Vocabulary(hashes[order], np.array([0, 1])[order], np.zeros(2), counts, 2, 0.0, 13, 4, 1, 1)
    rows = encoded(table, shared_value(spark, vocabulary)).orderBy("id").select("symbols").toArrow()
    assert pa.types.is_binary(rows.schema.field("symbols").type)
    number = {"a": 0, "b": 1}
    expected = [[*(number.get(w, 3) for w in (x or "").lower().split()), 2] for x in texts]
    (batch,) = rows.combine_chunks().to_batches()
    for low in (0, 2):  # a slice's places are its own
        symbols, begin, length = _symbols(batch.slice(low))
        assert [symbols[b : b + n].tolist() for b, n in zip(begin, length)] == expected[low:]


def test_rows_are_added_up_by_symbol():
    draw = np.random.default_rng(4)
    symbols = np.append(np.zeros(500, np.int64), draw.integers(1, 900, 1000))
    rows = draw.integers(-9, 9, (1500, 6)).astype(np.float32)  # exact in any order
    theirs, ours = np.zeros((901, 6), np.float32), np.zeros((901, 6), np.float32)
    np.add.at(theirs, symbols, rows)
    add_by_symbol(symbols, rows, ours)
    assert (ours == theirs).all()


def test_sums_by_symbol_have_the_order_of_reduceat():
    draw = np.random.default_rng(5)
    symbols = draw.permutation(np.repeat(np.arange(60), np.arange(60) // 3 + 1))  # 1 to 20 rows each
    rows = draw.normal(size=(len(symbols), 6)).astype(np.float32)
    order = np.argsort(symbols, kind="stable")
    theirs = np.add.reduceat(rows[order], np.flatnonzero(np.diff(symbols[order], prepend=-1)))
    ours = np.zeros((60, 6), np.float32)
    add_by_symbol(symbols, rows, ours, np.empty_like(rows))
    assert np.allclose(ours, theirs, rtol=1e-6, atol=1e-6)
