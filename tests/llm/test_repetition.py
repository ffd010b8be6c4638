from __future__ import annotations

import random
from collections import Counter

import pytest
from brute import spaced_words
from pyspark.sql import functions as F

from watchpost.llm import repetition as rp
from watchpost.llm.queries import op8_repetition_rules
from watchpost.llm.repetition import MAX_COVERAGE, base_failed, measure_repetition, without_repetition


def covered(words, width):
    grams = Counter(tuple(words[i : i + width]) for i in range(len(words) - width + 1))
    return {
        i + k
        for i in range(len(words) - width + 1)
        if grams[tuple(words[i : i + width])] > 1
        for k in range(width)
    }


def brute(text):
    words = spaced_words(text)
    lines, seen, dup, dup_chars = (text or "").split("\n"), set(), 0, 0
    for line in lines:
        if line in seen and spaced_words(line):
            dup += 1
            dup_chars += len(line)
        seen.add(line)
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": dup,
        "dup_line_chars": dup_chars,
        "line_chars": sum(map(len, lines)),
        "n_repeat_words": len(covered(words, 3)),
        **{f"dup_chars_{w}": sum(len(words[i]) for i in covered(words, w)) for w in rp.MAX_COVERAGE},
    }


def verdict(b):
    failed = b["n_words"] < 50 or 100 * b["n_repeat_words"] > 50 * b["n_words"]
    over = 100 * b["dup_line_chars"] > rp.MAX_LINE_PERCENT * b["line_chars"] or any(
        100 * b[f"dup_chars_{w}"] > p * b["word_chars"] for w, p in rp.MAX_COVERAGE.items()
    )
    return failed, not failed and not over


def texts(seed):
    rng = random.Random(seed)
    words = ["a", "bé", "漢字", "d#", "e|f", "long-word"]
    found = [None, "", " \n ", "\n\n", "a\na\n a\n", "x" * 5000, "same line\n" * 40, "é\x1cé é\x1cé é\x1cé"]
    for _ in range(30):
        n = rng.randrange(1, 120)
        found.append("".join(rng.choice(words) + rng.choice(" \n\t ") for _ in range(n)))
    unique = [f"w{i}" for i in range(200)]
    found.append(" ".join(unique))
    found.append(" ".join(unique[:80] + unique[:30]))
    found.append("\n".join([" ".join(unique[:60]), "a footer line of the site"] * 1 + ["x y z " + " ".join(unique[60:])]))
    found.append(" ".join(f"v{i % 7001}" for i in range(50_000)))
    return found


def test_measures_equal_brute_force(spark, documents):
    own = texts(2)
    rows = rp.measure_repetition(documents(own)).select("doc_id", "repetition.*").collect()
    assert len(rows) == len(own)
    for r in rows:
        expected = brute(own[r["doc_id"]])
        assert {k: r[k] for k in expected} == expected, own[r["doc_id"]]


def test_query_equals_brute_force(spark, sf_dir):
    own = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op8_repetition_rules(spark, sf_dir).collect()
    assert len(rows) == len(own)
    for r in rows:
        b = brute(own[r["doc_id"]])
        assert (r["base_failed"], r["kept"]) == verdict(b)
        assert all(r[k] == b[k] for k in b if k != "line_chars")


def test_filter_keeps_columns_and_clean_rows(spark, documents):
    own = texts(5)
    docs = documents(own).withColumn("n_words", F.lit("own"))
    kept = rp.without_repetition(docs)
    assert kept.schema == docs.schema
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i, t in enumerate(own) if verdict(brute(t))[1]]
    assert rp.without_repetition(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="already have"):
        rp.measure_repetition(docs, measures="n_words")


def passages(total, covered, width):
    """``total`` words of one length; passages of ``width`` words, each there twice, hold ``covered``."""
    number = iter(range(100_000))
    new = lambda n: [f"w{next(number):05d}" for _ in range(n)]
    own = [new(width) for _ in range(covered // (2 * width))]
    text = [w for p in own * 2 for w in [*p, *new(1)]]
    return " ".join(text + new(total - len(text)))


@pytest.mark.parametrize("gram, percent, width", [(5, 40, 6), (7, 35, 8), (10, 30, 12)])
def test_the_limit_of_each_length(spark, documents, gram, percent, width):
    """Just below its limit a text stays, just above it goes; shorter passages don't count for longer grams."""
    step = 2 * width
    total = 100 * step
    below, above = passages(total, percent * step, width), passages(total, (percent + 1) * step, width)
    docs = documents([below, above])
    assert [r["doc_id"] for r in without_repetition(docs).collect()] == [0]
    for row, covered in zip(measure_repetition(docs).orderBy("doc_id").collect(), (percent, percent + 1)):
        m = row["repetition"]
        assert m[f"dup_chars_{gram}"] * 100 == covered * m["word_chars"]
        assert all(m[f"dup_chars_{longer}"] == 0 for longer in MAX_COVERAGE if longer > width)


def test_the_limit_of_repeated_lines(spark, documents):
    """Lines of two long words, too short for repeated windows of three."""
    def text(repeated):
        lines = [f"{'a' * 45}{i:03d} {'b' * 46}{i % 50:03d}" for i in range(50)]
        unique = [f"{'c' * 90}{i:04d} n{i:03d}" for i in range(100 - 50 - repeated)]
        return "\n".join(x for pair in zip(lines + lines[:repeated], [*unique, *[""] * 100]) for x in pair if x)

    docs = documents([text(28), text(34)])
    assert [r["doc_id"] for r in without_repetition(docs).collect()] == [0]
    assert not any(r["failed"] for r in measure_repetition(docs).select(base_failed("repetition").alias("failed")).collect())


def test_repeated_headings_stay(spark, documents):
    """Records with a heading of ten words and twenty-five of their own."""
    heading = " ".join(f"h{i}" for i in range(10))
    text = "\n".join(f"{heading}\n" + " ".join(f"w{r}x{i}" for i in range(25)) for r in range(12))
    assert without_repetition(documents([text])).count() == 1

