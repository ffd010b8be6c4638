"""Each stage of the pipeline against brute force on what its predecessor has kept."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_decontaminate import brute as brute_matches
from test_jaccard_join import brute_components
from test_mixing import brute_targets
from test_repetition import brute as brute_measures
from test_repetition import verdict

import corpus_pipeline
from brute import spaced_words
from watchpost.llm.storage import written


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Rows after each stage, the documents first."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        rows = found[-1]
        frame = spark.createDataFrame(rows, docs.schema) if rows else docs.limit(0)
        result = stage(spark, frame, sf_dir)
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert result.columns == docs.columns
        found.append(result.collect())
    return found


def ids(rows):
    return Counter(r["doc_id"] for r in rows)


def test_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_duplicates", "decontamination", "source_mix", "shards",
    ]


def test_quality_rules(stages):
    before, after = stages[0], stages[1]
    assert ids(after) == Counter(r["doc_id"] for r in before if verdict(brute_measures(r["text"]))[1])
    assert 0 < len(after) < len(before)


def test_near_duplicates(stages):
    before, after = stages[1], stages[2]
    components = brute_components([(r["doc_id"], r["text"]) for r in before], width=5, percent=80)
    assert ids(after) == Counter(d for d, _, component in components if d == component)
    assert len(after) < len(before)


def test_decontamination(spark, sf_dir, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    before, after = stages[2], stages[3]
    assert ids(after) == Counter(r["doc_id"] for r in before if not brute_matches(r["text"], items)[1])
    assert len(after) < len(before)


def test_source_mix(stages):
    before, after = stages[3], stages[4]
    sizes = Counter()
    for r in before:
        sizes[r["source"]] += len(spaced_words(r["text"]))
    targets, copies = brute_targets(dict(sizes)), ids(after)
    for r in before:
        rate = targets[r["source"]] / sizes[r["source"]]
        assert int(rate) <= copies[r["doc_id"]] <= int(rate) + (rate > int(rate))
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}


def test_shards(stages):
    before, after = stages[4], stages[5]
    assert ids(after) == ids(before)
    columns = before[0].__fields__
    assert Counter(tuple(r[c] for c in columns) for r in after) == Counter(map(tuple, before))
    shard_of = {}
    for r in after:
        assert r["size"] == len(r["text"].encode()) + 16 and 0 <= r["shard"] < 40
        assert shard_of.setdefault(r["virtual_slot"], r["shard"]) == r["shard"]


def test_run_gives_the_last_stage(spark, sf_dir, stages):
    columns = stages[-1][0].__fields__
    rows = corpus_pipeline.run(spark, sf_dir).select(*columns).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, stages[-1]))


def test_extra_columns_go_through_all_stages(spark, sf_dir):
    """Columns that are named like the results or the inner columns of stages keep their values."""
    names = ["size", "shard", "target", "rate", "copies", "source_size", "text_crc32", "virtual_slot", "n", "component", "m", "node"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumns({c: F.concat(F.lit(c), "doc_id") for c in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"names-{name}")
        assert docs.columns[5:] == names
    rows = written(corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir), "names-shards").collect()
    assert rows
    made = {"size", "shard", "text_crc32", "virtual_slot"}
    for r in rows:
        assert all(r[f"own_{c}" if c in made else c] == f"{c}{r['doc_id']}" for c in names)
        assert 0 <= r["shard"] < 40 and r["size"] == len(r["text"].encode()) + 16


def test_empty_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0
