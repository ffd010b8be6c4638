from __future__ import annotations

import random
from hashlib import sha256

import numpy as np
import pytest
from brute import alnum_words
from pyspark.sql import functions as F

from watchpost.llm import decontaminate as dc
from watchpost.llm.queries import op3_decontaminate


def brute(text, items):
    """Words, hit words, items, by trying every window at every place."""
    words, hit, found = alnum_words(text), set(), set()
    for item_id, item in items:
        own = alnum_words(item)
        size = min(10, len(own))
        for k in range(len(own) - size + 1) if own else ():
            for p in range(len(words) - size + 1):
                if words[p : p + size] == own[k : k + size]:
                    hit |= set(range(p, p + size))
                    if item_id is not None:
                        found.add(str(item_id))
    return len(words), len(hit), sorted(found)


def answer(docs, benchmark, **options):
    rows = dc.match_benchmark(docs, benchmark, **options).select("doc_id", "benchmark_matches.*").collect()
    return {r["doc_id"]: r for r in rows}


def benchmark_of(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def texts_and_items(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(12)]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, line(rng.randrange(1, 25))) for i in range(12)] + [(12, "w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1")]
    items += [(13, None), (14, " .,"), (3, line(11)), (None, "nobody has id")]
    texts = [line(rng.randrange(0, 60)) for _ in range(20)]
    for _ in range(20):
        cut = items[rng.randrange(13)][1].split()
        a = rng.randrange(len(cut))
        texts.append(line(4) + " " + " ".join(cut[a:]).upper().replace(" ", ", ") + "! " + line(3))
    texts += [None, "", "?!", "w1 " * 40, items[2][1], "x nobody has id y", "é " + items[5][1] + " é"]
    return texts, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 100])
def test_matches_equal_brute_force(spark, documents, block_bytes):
    texts, items = texts_and_items(4)
    found = answer(documents(texts), benchmark_of(spark, items), block_bytes=block_bytes)
    for i, text in enumerate(texts):
        n, hit, ids = brute(text, items)
        row = found[i]
        assert (row["n_words"], row["n_hit"], row["items"]) == (n, hit, ids), text
        bits = np.unpackbits(np.frombuffer(row["hits"] or b"", np.uint8))
        assert bits.sum() == hit


def test_an_item_that_repeats_fills_no_block(spark, documents):
    """One item is a third of all rows; blocks are dealt by what is different."""
    texts, items = texts_and_items(4)
    many = items + [items[0]] * len(items)
    size = sum(len((t or "").encode()) for _, t in set(items))
    blocks = dc.benchmark_blocks(benchmark_of(spark, many), id_col="item_id", text_col="text", block_bytes=size // 2)
    assert sum(b.count() for b in blocks) == len({(str(i), t) for i, t in items})
    found = answer(documents(texts), benchmark_of(spark, many), block_bytes=size // 2)
    once = answer(documents(texts), benchmark_of(spark, items))
    assert {i: (r["n_hit"], r["items"]) for i, r in found.items()} == {i: (r["n_hit"], r["items"]) for i, r in once.items()}


def test_longest_matches_and_places(spark, documents):
    item = " ".join(f"b{i}" for i in range(30))
    docs = documents(["x " + " ".join(f"b{i}" for i in range(5, 29)) + " y " + " ".join(f"b{i}" for i in range(10))])
    (row,) = answer(docs, benchmark_of(spark, [(7, item)])).values()
    assert sorted((m["item_id"], m["start"], m["length"]) for m in row["matches"]) == [("7", 1, 24), ("7", 26, 10)]


def test_query_equals_brute_force(spark, sf_dir):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op3_decontaminate(spark, sf_dir).collect()
    assert len(rows) == len(texts) and sum(r["contaminated"] for r in rows) > 0
    for r in rows[::3] + [r for r in rows if r["contaminated"]]:
        n, hit, ids = brute(texts[r["doc_id"]], items)
        digest = sha256(",".join(ids).encode()).hexdigest()
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) == (n, hit, len(ids), digest)


def test_clean_rows_stay_as_they_are(spark, documents):
    texts, items = texts_and_items(9)
    docs = documents(texts).withColumn("n_hit", F.lit("own")).withColumn("item_id", F.lit(None).cast("string"))
    clean = dc.without_benchmark(docs, benchmark_of(spark, items))
    assert clean.schema == docs.schema
    assert sorted(r["doc_id"] for r in clean.collect()) == [
        i for i, t in enumerate(texts) if not brute(t, items)[1]
    ]
    assert dc.without_benchmark(docs, benchmark_of(spark, [])).count() == len(texts)
    assert dc.without_benchmark(docs.limit(0), benchmark_of(spark, items)).count() == 0
    with pytest.raises(ValueError, match="already have"):
        dc.match_benchmark(docs, benchmark_of(spark, items), found="n_hit")


def test_suffix_array_is_in_order():
    rng = np.random.default_rng(1)
    words = np.r_[rng.integers(1, 4, 200), np.zeros(20)].astype(np.int32)
    places = np.arange(200)
    ordered = dc.suffix_array(words, places, 16)
    keys = [tuple(words[p : p + 16]) for p in ordered]
    assert keys == sorted(keys) and sorted(ordered) == places.tolist()


def test_nothing_is_shuffled(spark, sf_dir, capsys):
    op3_decontaminate(spark, sf_dir).explain()
    assert "Exchange" not in capsys.readouterr().out
