"""A corpus from raw documents: five stages, each written and read again before the next.

1. quality rules: documents that fail the base rules or repeat themselves too much go;
2. near duplicates: of each group of documents whose sets of shingles of five words are similar by
   0.8, the row with the smallest id stays, rows without an id last;
3. decontamination: documents that hold a passage of the benchmark go;
4. mixing: documents are repeated or left out so that sources come near their targets;
5. sharding: each row gets a virtual slot and a shard.

All stages but the last return the columns of ``documents``.  A stage is given what its
predecessor has kept and judges it anew: shares and frequencies are those of its own input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from watchpost.llm.decontaminate import without_benchmark
from watchpost.llm.jaccard_join import without_near_duplicates
from watchpost.llm.mixing import mixed
from watchpost.llm.repetition import without_repetition
from watchpost.llm.sharding import with_shards
from watchpost.llm.storage import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Words of a shingle, and per cent by which near duplicates agree; op6 has its own contract.
NEAR_WIDTH = 5
NEAR_PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_repetition(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_near_duplicates(docs, width=NEAR_WIDTH, percent=NEAR_PERCENT, keep_unnamed=False)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return with_shards(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("shards", shards),
]

# The map of the last stage is made by a greedy search, which SQL can't express; tests hold the
# pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs
