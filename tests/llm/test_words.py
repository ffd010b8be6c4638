from __future__ import annotations

import numpy as np
import pyarrow as pa
from brute import ALNUM, LOWER, SPACED
from hypothesis import given, settings
from hypothesis import strategies as st

from watchpost.llm.batches import run_bounds, runs
from watchpost.llm.words import ALPHANUMERIC, NOT_SPACE, chunks, hash_words, rolling_hashes, split_words, word_hashes

TEXTS = st.lists(st.none() | st.text(alphabet="aB9 \t\n\x0b\x1cé-ß漢 ", max_size=30), max_size=12)


@settings(deadline=None, max_examples=150)
@given(TEXTS, st.integers(1, 40))
def test_words_equal_the_patterns(texts, chunk_bytes):
    for pattern, kind in ((SPACED, NOT_SPACE), (ALNUM, ALPHANUMERIC)):
        found = []
        for begin, data, offsets in chunks(pa.array(texts, pa.string()), chunk_bytes):
            assert begin == len(found)
            words = split_words(data, offsets, kind, lower=True)
            for a, z in zip(words.first[:-1], words.first[1:]):
                found.append([words.word(i).decode() for i in range(a, z)])
            flat = [w.encode() for text in found[begin:] for w in text]
            assert np.array_equal(word_hashes(words), hash_words(flat)) if flat else True
        assert found == [pattern.findall((t or "").translate(LOWER)) for t in texts]


def test_sliced_column():
    column = pa.array(["a b", None, "c", "d e f"]).slice(1, 3)
    (_, data, offsets), *rest = chunks(column)
    assert split_words(data, offsets, NOT_SPACE).counts.tolist() == [0, 1, 3] and not rest
    assert list(chunks(pa.array([], pa.string()))) == []


def test_hashes_tell_words_apart():
    words = [b"a", b"b", b"ab", b"ba", b"aa", b"a" * 48, b"a" * 49, b"a" * 50, "é".encode()]
    assert len(set(hash_words(words).tolist())) == len(words)
    h = hash_words([b"a", b"b", b"a", b"b", b"a"])
    assert rolling_hashes(h, 2)[0] == rolling_hashes(h, 2)[2] != rolling_hashes(h, 2)[1]
    assert len(rolling_hashes(h, 6)) == 0


@settings(deadline=None, max_examples=100)
@given(st.lists(st.integers(0, 6), max_size=60), st.integers(1, 9))
def test_runs_are_whole(keys, size):
    keys = sorted(keys)
    batches = [
        pa.record_batch([pa.array(keys[i : i + size]), pa.array(range(i, min(i + size, len(keys))))], ["k", "i"])
        for i in range(0, len(keys), size)
    ]
    tables = list(runs(iter(batches), "k"))
    assert [i for t in tables for i in t.column("i").to_pylist()] == list(range(len(keys)))
    found = [t.column("k").to_pylist()[a:z] for t in tables for a, z in run_bounds(t, "k")]
    assert found == [[k] * keys.count(k) for k in sorted(set(keys))]
