from __future__ import annotations

import pytest
from brute import alnum_words
from pyspark.sql import functions as F

from watchpost.llm import licences
from watchpost.llm.licence_templates import BASE_PHRASES, TEMPLATES
from watchpost.llm.queries import op10_licence_scan


def brute_base(text):
    words = alnum_words(text)
    places, labels = [], set()
    for phrase, label in BASE_PHRASES:
        own = phrase.split()
        for i in range(len(words) - len(own) + 1):
            if words[i : i + len(own)] == own:
                places.append(i)
                labels.add(label)
    return len(words), sorted(places), sorted(labels)


def scan(docs, **options):
    rows = licences.scan_licences(docs, **options).select("doc_id", "licences.*").orderBy("doc_id").collect()
    return [r.asDict() for r in rows]


def test_query_holds_all_base_places(spark, sf_dir):
    folder = f"{sf_dir}/../sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op10_licence_scan(spark, folder).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        n, places, labels = brute_base(texts[r["doc_id"]])
        assert (r["n_words"], r["n_base"], r["base_labels"]) == (n, len(places), ",".join(labels))
        assert (r["first_word"], r["last_word"]) == ((places[0], places[-1]) if places else (None, None))
        assert set(labels) <= set(r["labels"].split(",")) | {""} and 0 <= r["score"] <= 1
    assert {"gpl-3", "mit", "apache-2", "cc-by-nc"} <= {x for r in rows for x in r["labels"].split(",")}


def test_every_template_is_found_in_a_text(spark, documents):
    texts = [f"Lorem ipsum.\n\n# {t.notice}!\nDolor sit amet." for t in TEMPLATES]
    for row, template in zip(scan(documents(texts)), TEMPLATES):
        assert template.label in row["labels"] and row["score"] == 1.0


def test_key_phrases_are_needed(spark, documents):
    notice = next(t.notice for t in TEMPLATES if t.label == "gpl-3")
    changed = [notice.replace("version 3", "version 9"), notice.replace("This work is", "My thing was")]
    found = scan(documents(changed))
    assert found[0]["labels"] == [] and found[0]["score"] == 0.0
    assert found[1]["labels"] == ["gpl-3"] and 0.7 < found[1]["score"] < 1.0


def test_rare_words_alone_are_no_licence(spark, documents):
    words = sorted({w for t in TEMPLATES for w in alnum_words(t.notice)})
    assert scan(documents([" ".join(words), " ".join(reversed(words))])) == [
        {"doc_id": i, "n_words": len(words), "base_places": [], "base_labels": [], "labels": [], "score": 0.0}
        for i in range(2)
    ]


def test_templates_are_indexed_by_their_rarest_words(spark, documents):
    notice = "Licensed under the Apache License, Version 2.0"
    docs = documents(["the license version 2 0 under licensed"] * 50 + [notice])
    index = licences.Index(TEMPLATES, BASE_PHRASES)
    index.set_frequencies(*licences._frequencies(docs, "text", index), 1)
    t = next(i for i, x in enumerate(TEMPLATES) if x.label == "apache-2")
    rare = {index.vocabulary[w - 1] for w, own in zip(index.posting_word, index.posting_template) if own == t}
    assert rare == {b"apache"}


def test_edge_cases(spark, documents):
    long = "word " * 60_000 + "under the MIT license " + "word " * 60_000
    texts = [None, "", "...", "MIT", "under the mit license", "cc by nc cc by nc", long, "apache license version 2"]
    docs = documents(texts).withColumn("labels", F.lit("own"))
    found = scan(docs)
    for row, text in zip(found, texts):
        n, places, labels = brute_base(text)
        assert (row["n_words"], row["base_places"], row["base_labels"]) == (n, places, labels)
    assert scan(docs.limit(0)) == []
    # A phrase doesn't go from one text into the next.
    assert [r["labels"] for r in scan(documents(["under the mit", "license"]))] == [[], []]
    with pytest.raises(ValueError, match="already have"):
        licences.scan_licences(docs, found="labels")


@pytest.mark.parametrize("template", TEMPLATES, ids=lambda t: t.label)
def test_a_word_put_in_or_left_out_hides_no_notice(spark, documents, template):
    """At each place of the notice that isn't in a key phrase."""
    words = alnum_words(template.notice)
    keys = [key.split() for key in template.key_phrases]
    whole = lambda own: all(any(own[i : i + len(k)] == k for i in range(len(own))) for k in keys)
    changed = []
    for i in range(len(words) + 1):
        changed.append([*words[:i], "own", *words[i:]])
        changed.append([*words[:i], "these", "two", *words[i:]])
        if i < len(words) and len(words) >= 6:
            changed.append([*words[:i], *words[i + 1 :]])
    changed = [c for c in changed if whole(c)]
    for row, text in zip(scan(documents(["some words " + " ".join(c) + " and more" for c in changed])), changed):
        assert template.label in row["labels"], " ".join(text)


def test_wording_between_the_words_of_a_notice(spark, documents):
    texts = ["The code is licensed under the terms of the GNU General Public License, version 3."]
    assert scan(documents(texts))[0]["labels"] == ["gpl-3"]
