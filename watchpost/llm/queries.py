"""Registered queries of this subpackage, each over the whole table it is meant for."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from watchpost.llm.centroids import cluster_vectors, with_inertia
from watchpost.llm.decontaminate import match_benchmark
from watchpost.llm.jaccard_join import jaccard_components
from watchpost.llm.line_dedup import drop_boilerplate_lines
from watchpost.llm.licences import scan_licences
from watchpost.llm.mixing import n_words, source_targets, with_copies
from watchpost.llm.quote_links import link_quotations
from watchpost.llm.recurrent_lm import score_documents
from watchpost.llm.repetition import MAX_COVERAGE, base_failed, measure_repetition, too_repetitive
from watchpost.llm.secrets import scan_secrets
from watchpost.llm.sharding import balanced_map, digests, numbered
from watchpost.llm.storage import written
from watchpost.llm.token_alignment import align_tokens
from watchpost.llm.warc import read_archives, write_archives


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_boilerplate_lines(_table(spark, sf_dir, "pages"))


def op2_warc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_archives(_table(spark, sf_dir, "pages"))
    return read_archives(manifest, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    found = match_benchmark(docs.select("doc_id", "text"), benchmark, found="m", keep=["doc_id"])
    return found.select(
        "doc_id",
        "m.n_words",
        "m.n_hit",
        F.size("m.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("m.items", ","), 256).alias("items_sha256"),
        (F.col("m.n_hit") > 0).alias("contaminated"),
    )


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan_secrets(docs, found="s", keep=["doc_id"])
    number = lambda kind: F.size(F.filter("s", lambda x: x["kind"] == kind)).cast("long")
    joined = lambda spans: F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )
    return found.select(
        "doc_id",
        *(number(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")),
        F.sha2(joined(F.filter("s", lambda x: x["kind"] != "literal")), 256).alias("base_sha256"),
        joined(F.col("s")).alias("spans"),
        number("literal").alias("n_literal"),
    )


def op5_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_quotations(_table(spark, sf_dir, "conversations"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    drawn = with_copies(docs, source_targets(docs)).withColumn("size", n_words(F.col("text")))
    return drawn.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op8_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    measured = measure_repetition(docs, measures="m", keep=["doc_id"])
    return measured.select(
        "doc_id",
        *(f"m.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        base_failed("m").alias("base_failed"),
        (~base_failed("m") & ~too_repetitive("m")).alias("kept"),
        "m.dup_line_chars",
        *(f"m.dup_chars_{width}" for width in MAX_COVERAGE),
    )


def op9_slot_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = written(digests(_table(spark, sf_dir, "documents").select("doc_id", "text")), "sharding-digests")
    return numbered(records, balanced_map(records)).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )


def op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan_licences(docs, found="m", keep=["doc_id"])
    return found.select(
        "doc_id",
        "m.n_words",
        F.size("m.base_places").cast("long").alias("n_base"),
        F.array_min("m.base_places").alias("first_word"),
        F.array_max("m.base_places").alias("last_word"),
        F.array_join("m.base_labels", ",").alias("base_labels"),
        F.array_join("m.labels", ",").alias("labels"),
        "m.score",
    )


def op11_recurrent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = align_tokens(_table(spark, sf_dir, "documents"), digest=True)
    return aligned.withColumnsRenamed({"id": "doc_id", "groups": "groups_sha256"})


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    clusters, centroids = cluster_vectors(_table(spark, sf_dir, "embeddings"))
    digests = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in centroids.tolist()]
    digest = F.element_at(F.array(*map(F.lit, digests or [""])), F.col("cluster") + 1)
    return with_inertia(clusters).withColumn("centroid_sha256", digest)


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_warc_roundtrip": op2_warc_roundtrip,
    "op3_decontaminate": op3_decontaminate,
    "op4_secret_scan": op4_secret_scan,
    "op5_quotation_links": op5_quotation_links,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_source_mixing": op7_source_mixing,
    "op8_repetition_rules": op8_repetition_rules,
    "op9_slot_sharding": op9_slot_sharding,
    "op10_licence_scan": op10_licence_scan,
    "op11_recurrent_scores": op11_recurrent_scores,
    "op12_token_alignment": op12_token_alignment,
    "op13_centroid_clustering": op13_centroid_clustering,
}
