"""WARC archives whose records are compressed one by one with a shared Zstandard dictionary.

An archive is a skippable frame that holds the dictionary, then a frame for each record, so any
record can be read without the others.  Each task writes one archive: it trains the dictionary on
the first records it gets, up to ``TRAIN_BYTES``, writes the dictionary, and streams all
records after it.  Records with equal payloads are one response, that with the largest id, and
revisits that refer to it and hold no payload.

Which archives count is said by a manifest, a table that Spark commits as a whole; an attempt
that was lost or run twice leaves a file that no manifest names.  It is a few files, however many
archives there are.  Files are written and read by
URI through Arrow's file systems, in the shared folder.

Roles need one shuffle of the payloads, by digest, and the largest id of each digest is found
before with map-side combine; the join is split by Spark where a third of all payloads are equal.

Edge cases: a null payload is empty; a null id is smaller than any other; rows with an equal id and
payload are written each, and where they are the largest, each as a response; a null or odd
address is percent-encoded or replaced by the record's own; an empty table makes no archive.
Only the columns named are looked at.
"""

from __future__ import annotations

import uuid
from base64 import b32encode
from collections.abc import Iterable, Iterator
from hashlib import sha1
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from watchpost.llm.storage import new_folder

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D  # a skippable frame with a dictionary
CRLF = b"\r\n"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DICTIONARY_BYTES = 64 << 10
TRAIN_BYTES = 2 << 20
SAMPLE_BYTES = 4 << 10
LEVEL = 3
READ_BYTES = 64 << 10
CAPTURED = "2024-01-01T00:00:00Z"


# --- records ------------------------------------------------------------------------------


def record_uri(page_id: int | None) -> str:
    return "urn:page:" + ("" if page_id is None else str(page_id))


def digest_of(payload: bytes) -> str:
    """Base32 of the SHA-1, upper-case."""
    return b32encode(sha1(payload).digest()).decode()


def make_record(
    page_id: int | None, url: str | None, payload: bytes, response: int | None, is_response: bool, captured: str
) -> bytes:
    """A response with its payload, or a revisit that refers to one."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if is_response else http
    headers = {
        "WARC-Type": "response" if is_response else "revisit",
        "WARC-Record-ID": f"<{record_uri(page_id)}>",
        "WARC-Date": captured,
        "WARC-Target-URI": quote(url, safe=":/?#[]@!$&'()*+,;=%~") if url else record_uri(page_id),
        "WARC-Payload-Digest": f"sha1:{digest_of(payload)}",
        "Content-Type": "application/http; msgtype=response",
    }
    if not is_response:
        headers |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<{record_uri(response)}>"}
    headers["Content-Length"] = str(len(block))
    lines = [VERSION, *(f"{name}: {value}".encode() for name, value in headers.items())]
    return CRLF.join(lines) + CRLF + CRLF + block + CRLF + CRLF


def parse_record(record: bytes) -> dict:
    """Headers, by lower-case name, and the ``block`` of a record."""
    head, _, rest = record.partition(CRLF + CRLF)
    version, *lines = head.split(CRLF)
    if version != VERSION:
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    headers = {}
    for line in lines:
        name, _, value = line.decode().partition(":")
        headers[name.lower()] = value.strip()
    length = int(headers["content-length"])
    if len(rest) != length + 2 * len(CRLF):
        raise ValueError("a WARC record of another length than it says")
    return headers | {"block": rest[:length]}


# --- archives -----------------------------------------------------------------------------


def train_dictionary(records: Iterable[bytes]) -> bytes:
    """A dictionary from pieces of records; empty if there is too little to learn from."""
    pieces = [r[a : a + SAMPLE_BYTES] for r in records for a in range(0, len(r), SAMPLE_BYTES)]
    size = min(DICTIONARY_BYTES, sum(map(len, pieces)) // 8)
    try:
        return zstandard.train_dictionary(size, pieces, k=512, d=8, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_archive(out: BinaryIO, records: Iterator[bytes]) -> int:
    """Write the dictionary's frame and one frame for each record; return the number of records.

    At most ``TRAIN_BYTES`` of records, and the one that goes beyond, are held at once.
    """
    first, size = [], 0
    for record in records:
        first.append(record)
        size += len(record)
        if size >= TRAIN_BYTES:
            break
    dictionary = train_dictionary(first)
    out.write(DICTIONARY_MAGIC.to_bytes(4, "little") + len(dictionary).to_bytes(4, "little") + dictionary)
    options = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
    compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, **options)
    number = 0
    for part in (first, records):
        for record in part:
            out.write(compressor.compress(record))
            number += 1
    return number


def read_archive(source: BinaryIO) -> Iterator[bytes]:
    """The records of an archive, one at a time."""
    head = source.read(8)
    if int.from_bytes(head[:4], "little") != DICTIONARY_MAGIC:
        raise ValueError("the archive doesn't begin with a dictionary")
    dictionary = source.read(int.from_bytes(head[4:], "little"))
    options = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
    decompressor = zstandard.ZstdDecompressor(**options)
    data = source.read(READ_BYTES)
    while data:
        frame, parts = decompressor.decompressobj(), []
        while True:
            parts.append(frame.decompress(data))
            if frame.eof:
                data = frame.unused_data or source.read(READ_BYTES)
                break
            data = source.read(READ_BYTES)
            if not data:
                raise ValueError("the archive ends within a record")
        yield b"".join(parts)


# --- tables -------------------------------------------------------------------------------

MANIFEST = "archive string, records long, bytes long"
MANIFEST_FILES = 8


def with_roles(pages: DataFrame, *, id_col: str, url_col: str, payload_col: str, min_bytes: int) -> DataFrame:
    """``(page_id, url, payload, response, is_response)``.

    Of payloads that are equal and have at least ``min_bytes``, the row with the largest id is the
    response; ``response`` is that id.
    """
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("string")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
    keyed = rows.withColumn("digest", F.sha1(F.encode("payload", "UTF-8")))
    largest = keyed.groupBy("digest").agg(F.max("page_id").alias("response"))
    small = F.octet_length("payload") < min_bytes
    return keyed.join(largest, "digest").select(
        "page_id", "url", "payload", "response", (small | F.col("page_id").eqNullSafe(F.col("response"))).alias("is_response")
    )


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_bytes: int = 0,
    captured: str = CAPTURED,
) -> DataFrame:
    """Write a record for each row; return the written manifest ``(archive, records, bytes)``.

    Archives and manifest go to ``folder``, a URI or path that all executors reach; default: a new
    one in the shared folder.  A path without a scheme is on Spark's default file system, for tasks as
    for Spark; a file system that Arrow doesn't know is refused before any task begins.
    """
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    place = _qualified(spark, folder)
    rows = with_roles(pages, id_col=id_col, url_col=url_col, payload_col=payload_col, min_bytes=min_bytes)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for batch in batches:
                for page_id, url, payload, response, is_response in zip(*(column for column in batch.columns)):
                    yield make_record(
                        page_id.as_py(),
                        url.as_py(),
                        payload.as_buffer().to_pybytes(),
                        response.as_py(),
                        is_response.as_py(),
                        captured,
                    )

        own = records()
        first = next(own, None)
        if first is None:
            return
        system, path = _open(place)
        system.create_dir(f"{path}/archives", recursive=True)
        archive = f"{path}/archives/{uuid.uuid4().hex}.warc.zst"
        with system.open_output_stream(archive, compression=None) as out:
            number = write_archive(out, _chained(first, own))
            size = out.tell()
        yield pa.record_batch([[f"{place}/archives/{archive.rpartition('/')[2]}"], [number], [size]], ["archive", "records", "bytes"])

    # A row for each archive; a file for each would be as many files again, with what it takes to make them.
    rows.mapInArrow(write, MANIFEST).repartition(MANIFEST_FILES).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def _chained(first: bytes, rest: Iterator[bytes]) -> Iterator[bytes]:
    yield first
    yield from rest


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder as a URI, with the scheme under which Spark knows it, for Arrow."""
    spark.range(1).coalesce(1).write.parquet(f"{folder}/place")
    (file,) = spark.read.parquet(f"{folder}/place").inputFiles()
    whole = file.rpartition("/place/")[0]
    try:
        _open(whole)
    except (pa.ArrowException, OSError) as error:
        raise ValueError(f"archives can't be written to {whole}: {error}") from error
    return whole


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


READ_SCHEMA = (
    "page_id long, target_uri string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, payload binary"
)
FLUSH_BYTES = 8 << 20


def read_archives(manifest: DataFrame, *, payloads: bool = True) -> DataFrame:
    """A row for each record of the manifest's archives.

    ``payload_bytes`` and ``payload_digest`` are of the full payload, also for revisits, whose own
    ``payload`` is null; so is every payload unless ``payloads``.  A response whose payload hasn't
    the digest that its header says, or an archive with another number of records than the
    manifest says, is an error.
    """
    number = manifest.count()
    paths = manifest.repartition(max(1, number), "archive") if number else manifest

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in READ_SCHEMA.split(", ")]
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        for batch in batches:
            for archive, expected in zip(batch.column("archive").to_pylist(), batch.column("records").to_pylist()):
                system, path = _open(archive)
                rows, held, count = [], 0, 0
                with system.open_input_stream(path, compression=None) as source:
                    for record in read_archive(source):
                        rows.append(_record_row(record, payloads))
                        held += len(rows[-1][-1] or b"") + 200
                        count += 1
                        if held > FLUSH_BYTES:
                            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                            rows, held = [], 0
                if count != expected:
                    raise ValueError(f"{archive} has {count} records, not {expected}")
                if rows:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return paths.mapInArrow(read, READ_SCHEMA)


def _page_of(uri: str | None) -> int | None:
    number = (uri or "").strip("<>").removeprefix("urn:page:")
    return int(number) if number else None


def _record_row(record: bytes, payloads: bool) -> tuple:
    parsed = parse_record(record)
    head, _, payload = parsed["block"].partition(CRLF + CRLF)
    digest = parsed["warc-payload-digest"].removeprefix("sha1:")
    length = next(int(x.partition(b":")[2]) for x in head.split(CRLF) if x.lower().startswith(b"content-length:"))
    kind = parsed["warc-type"]
    if kind == "response" and (digest_of(payload) != digest or len(payload) != length):
        raise ValueError(f"{parsed['warc-record-id']}: another payload than its header says")
    return (
        _page_of(parsed["warc-record-id"]),
        parsed["warc-target-uri"],
        length,
        digest,
        kind,
        _page_of(parsed.get("warc-refers-to")),
        payload if payloads and kind == "response" else None,
    )
