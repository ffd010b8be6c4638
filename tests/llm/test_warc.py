from __future__ import annotations

import io
from base64 import b32encode
from hashlib import sha1

import pytest
import zstandard
from pyspark.sql import functions as F

from watchpost.llm import warc
from watchpost.llm.queries import op2_warc_roundtrip


def expected(rows, min_bytes=0):
    """``(page_id, bytes, digest, type, refers_to)`` by the rules, for rows of id and html."""
    largest = {}
    for page, html in rows:
        largest.setdefault(html or "", []).append(page)
    found = []
    for page, html in rows:
        data = (html or "").encode()
        top = max((p for p in largest[html or ""] if p is not None), default=None)
        revisit = len(data) >= min_bytes and page != top
        digest = b32encode(sha1(data).digest()).decode()
        found.append((page, len(data), digest, "revisit" if revisit else "response", top if revisit else None))
    return sorted(found, key=str)


def answer(df):
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_query_equals_the_rules(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html").collect()]
    assert answer(op2_warc_roundtrip(spark, sf_dir)) == expected(rows)


ROWS = [
    (1, "http://a/é x", "same"),
    (9, None, "same"),
    (4, "", "same"),
    (5, "http://b/\r\nWARC-Type: x", None),
    (6, "u", ""),
    (7, "u", "\r\n\r\nWARC/1.1\r\n\x00é" * 50),
    (8, "u", "long " * 400_000),
    (2, "u", "twice"),
    (2, "u", "twice"),
    (None, "u", "nobody"),
    (None, None, "same"),
]


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_edge_cases(spark, min_bytes):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    manifest = warc.write_archives(pages, min_bytes=min_bytes)
    back = warc.read_archives(manifest)
    assert answer(back) == expected([(p, h) for p, _, h in ROWS], min_bytes)
    html = {(p, (h or "").encode()) for p, _, h in ROWS}
    rows = back.collect()
    assert {(r["page_id"], bytes(r["payload"])) for r in rows if r["record_type"] == "response"} <= html
    assert all(r["payload"] is None for r in rows if r["record_type"] == "revisit")
    assert sum(m["records"] for m in manifest.collect()) == len(ROWS)


def test_the_manifest_is_a_few_files(spark):
    pages = spark.createDataFrame([(k, "u", f"page {k}") for k in range(300)], "page_id long, url string, html string")
    given = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in given}
    try:
        for k, v in given.items():
            spark.conf.set(k, v)
        manifest = warc.write_archives(pages)
        assert manifest.count() > 30
        assert manifest.agg(F.sum("records")).first()[0] == 300
        assert len(manifest.inputFiles()) <= 8
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(warc.write_archives(pages)).count() == 0


def test_a_folder_without_scheme_is_on_sparks_file_system(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/1", "<p>x</p>")], "page_id long, url string, html string")
    manifest = warc.write_archives(pages, str(tmp_path / "plain folder"))
    (row,) = manifest.collect()
    assert row["archive"].startswith("file:/") and warc.read_archives(manifest).first()["page_id"] == 1
    assert (tmp_path / "plain folder" / "manifest").is_dir()


def test_a_file_system_that_arrow_does_not_know_is_refused(spark, tmp_path):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.there.link./in", f"file://{tmp_path}")
    pages = spark.createDataFrame([(1, "http://a/1", "x")], "page_id long, url string, html string")
    with pytest.raises(ValueError, match="can't be written to viewfs"):
        warc.write_archives(pages, "viewfs://there/in/archives")


def records(n):
    return [warc.make_record(i, f"http://a/{i}", f"<html><p>page {i} of many</p></html>".encode(), i, True, "d") for i in range(n)]


@pytest.mark.parametrize("n", [1, 3, 2000])
def test_archive_round_trip(n):
    own, out = records(n), io.BytesIO()
    assert warc.write_archive(out, iter(own)) == n
    out.seek(0)
    assert list(warc.read_archive(out)) == own
    assert out.getvalue()[:4] == bytes.fromhex("5d2a4d18")


def test_the_dictionary_is_used_and_frames_stand_alone():
    own, out = records(2000), io.BytesIO()
    warc.write_archive(out, iter(own))
    data = out.getvalue()
    size = int.from_bytes(data[4:8], "little")
    assert size > 0
    plain = sum(len(zstandard.ZstdCompressor(level=warc.LEVEL).compress(r)) for r in own)
    assert len(data) - size < 0.5 * plain
    with pytest.raises(zstandard.ZstdError):  # not without the dictionary
        zstandard.ZstdDecompressor().decompressobj().decompress(data[8 + size :])
    # A reader that knows no dictionaries skips the frame.
    assert zstandard.ZstdDecompressor().decompressobj().decompress(data[: 8 + size]) == b""


def test_damage_is_an_error(spark):
    own, out = records(3), io.BytesIO()
    warc.write_archive(out, iter(own))
    with pytest.raises(ValueError, match="ends within"):
        list(warc.read_archive(io.BytesIO(out.getvalue()[:-9])))
    with pytest.raises(ValueError, match="dictionary"):
        list(warc.read_archive(io.BytesIO(b"abcdefgh")))
    with pytest.raises(ValueError, match="payload"):
        warc._record_row(own[0].replace(b"many</p>", b"more</p>"), True)
