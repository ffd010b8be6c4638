"""Tokens of two tokenizers aligned by the places where both end.

A document is encoded by a byte-level BPE (A) and a sentence-piece model (B) over the same bytes, a
space and the text.  Where tokens of both end, the document can be cut; what lies between two cuts
is a group, whose A and B tokens are linked, each with each.

**Divide and conquer.**  An interval between two cuts is halved: from its middle A end, a bisect
finds the first B end there or later, another one the first A end there or later, and so on until
both agree; if that leads to the end of the interval, the same is done towards its beginning.  A
common end cuts the interval into two, which are worked on in the same way; an interval without one
is a group.  All intervals of a few hundred kilobytes of text are halved at once, as numpy arrays, so the
number of steps is the depth of the halving, not the number of tokens.

**Corpus-wide counts.**  Tasks write one row for each document, with its different pairs of ids as
a list of integers.  The pairs are counted by Spark with map-side combine.  Each pair of a document
then meets its count in a join, and the sums of a document are added up before they are shuffled.
The table of counts is broadcast only if its rows, which are counted first, are at most
``broadcast_pairs``; beyond, it is a shuffled join, whose hot pairs Spark splits.  The highest count
of each A id is a table of at most as many rows as A has ids, which is broadcast always.

The vocabulary files are read by the driver, 2 MB here, and go to tasks as a broadcast variable, so
executors need no copy.  A is the vocabulary of the ``.json`` file; its merges are in the order of
ids (checked), so that ids are ranks and a rank-based encoder gives the same tokens.

Edge cases: a null or empty text has no tokens, nor has one whose A or B tokens don't join to its
bytes (a text with U+2581, which B can't tell from a space): zeros and no groups.  Special tokens
written in a text are plain text.  A null id is a document; rows that repeat an id or a text are
documents of their own; an empty table gives an empty result; other columns are not read.  Time and
memory grow in proportion to a text's tokens; a group of very many tokens, such as a run of one
character, is linked by its different ids, not by its tokens.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchpost.llm.batches import list_array
from watchpost.llm.storage import shared_value, value_of, written

TOKENIZERS = "/opt/tokenizers"
CHUNK_CHARS = 1 << 18  # of texts aligned at once, so that arrays stay in cache; a longer text is a chunk of its own
LARGE_GROUP = 256  # links from which a group is linked by different ids
BROADCAST_PAIRS = 4_000_000  # rows of 16 bytes

# Fixed value: how the byte-level tokenizer cuts a text before merging.
BYTE_LEVEL_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


@dataclass(frozen=True)
class Vocabularies:
    """Contents of the files of both tokenizers, and how many ids they have."""

    byte_level: bytes
    pieces: bytes
    n_a: int
    n_b: int

    @classmethod
    def read(cls, folder: str = TOKENIZERS, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model") -> Vocabularies:
        from sentencepiece import SentencePieceProcessor

        byte_level, pieces = Path(folder, a).read_bytes(), Path(folder, b).read_bytes()
        n_a = max(byte_ranks(byte_level).values()) + 1
        return cls(byte_level, pieces, n_a, SentencePieceProcessor(model_proto=pieces).vocab_size())


def byte_of_letter() -> dict[str, int]:
    """Letters by which byte-level vocabularies write bytes: printable ones stand for themselves,
    the others, in order, for letters from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + k): b for k, b in enumerate(others)}


def byte_ranks(byte_level: bytes) -> dict[bytes, int]:
    """Bytes of each token of the vocabulary, with its id, which is its rank too."""
    letters = byte_of_letter()
    model = json.loads(byte_level)["model"]
    vocabulary = model["vocab"]
    merged = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if merged != sorted(merged):
        raise ValueError("ids of the vocabulary are not in the order of its merges")
    return {bytes(letters[c] for c in token): i for token, i in vocabulary.items()}


class Encoders:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, vocabularies: Vocabularies):
        import tiktoken
        from sentencepiece import SentencePieceProcessor

        ranks = byte_ranks(vocabularies.byte_level)
        self.a = tiktoken.Encoding("byte-level", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = SentencePieceProcessor(model_proto=vocabularies.pieces)
        self.bytes_a = [b""] * vocabularies.n_a
        for token, i in ranks.items():
            self.bytes_a[i] = token
        self.bytes_b = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(map(self.b.id_to_piece, range(vocabularies.n_b)))
        ]
        self.length_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.flat_a, self.flat_b = (np.frombuffer(b"".join(x), np.uint8) for x in (self.bytes_a, self.bytes_b))

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both for each text; none if their bytes aren't those of the text."""
        none = np.empty(0, np.int64)
        spaced = [" " + text if text else "" for text in texts]
        a = [self.a.encode_to_numpy(x, disallowed_special=()).astype(np.int64) if x else none for x in spaced]
        b = [self.b.EncodeAsNumpy(x[1:]).astype(np.int64) if x else none for x in spaced]
        whole = [x.encode() for x in spaced]
        if self._join_to(whole, a, self.flat_a, self.length_a) and self._join_to(whole, b, self.flat_b, self.length_b):
            return list(zip(a, b))
        # Somewhere they don't: each text by itself.
        fits = [
            self._join_to([w], [x], self.flat_a, self.length_a) and self._join_to([w], [y], self.flat_b, self.length_b)
            for w, x, y in zip(whole, a, b)
        ]
        return [(x, y) if fit else (none, none) for x, y, fit in zip(a, b, fits)]

    @staticmethod
    def _join_to(whole: list[bytes], ids: list[np.ndarray], flat: np.ndarray, length: np.ndarray) -> bool:
        """Whether the bytes of each text's tokens are the text's bytes."""
        if any(len(w) != length[x].sum() for w, x in zip(whole, ids)):
            return False
        tokens = np.concatenate(ids)
        sizes = length[tokens]
        begins = np.cumsum(length) - length
        places = np.repeat(begins[tokens] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        return np.array_equal(flat[places], np.frombuffer(b"".join(whole), np.uint8))


def _common_ends(
    a: np.ndarray, b: np.ndarray, low: np.ndarray, high: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """For intervals ``low < high`` of boundaries of ``a``, whose ends are common, the number of a
    common boundary in between in ``a`` and in ``b``, near the middle; 0 where there is none."""
    at, found_a, found_b = (low + high) // 2, np.zeros_like(low), np.zeros_like(low)
    for side, step, limit in (("left", 0, high), ("right", -1, low)):
        rows = np.flatnonzero(found_a == 0)
        i = at[rows]
        while len(rows):
            end = a[i]
            j = np.searchsorted(b, end, side) + step
            met = b[j]
            moved = met != end
            if moved.any():
                i = i.copy()
                i[moved] = np.searchsorted(a, met[moved], side) + step
            inside = i != limit[rows]
            hit = inside & (a[i] == met)
            found_a[rows[hit]], found_b[rows[hit]] = i[hit], j[hit]
            on = inside & ~hit
            rows, i = rows[on], i[on]
    return found_a, found_b


def groups(a: np.ndarray, b: np.ndarray, low_a: np.ndarray, low_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where groups end, as boundaries of ``a`` and of ``b``.

    ``a`` and ``b`` hold the byte places of boundaries, the first of them 0; ``low_a`` and ``low_b``
    say at which of them the documents begin and, last, where all end.
    """
    partner = np.zeros(len(a), np.int64)
    partner[low_a] = low_b
    cut = np.zeros(len(a), bool)
    cut[low_a] = True
    la, ha, lb, hb = low_a[:-1], low_a[1:], low_b[:-1], low_b[1:]
    while True:
        open_ = (ha - la > 1) & (hb - lb > 1)  # one token of either can't be cut
        la, ha, lb, hb = la[open_], ha[open_], lb[open_], hb[open_]
        if not len(la):
            break
        i, j = _common_ends(a, b, la, ha)
        cuts = i > 0
        la, ha, lb, hb, i, j = la[cuts], ha[cuts], lb[cuts], hb[cuts], i[cuts], j[cuts]
        cut[i], partner[i] = True, j
        la, ha = np.concatenate([la, i]), np.concatenate([i, ha])
        lb, hb = np.concatenate([lb, j]), np.concatenate([j, hb])
    cut[0] = False
    ends = np.flatnonzero(cut)
    return ends, partner[ends]


@dataclass
class Aligned:
    """Tokens of several documents, one after the other, and their groups."""

    a: np.ndarray  # ids
    b: np.ndarray
    first_a: np.ndarray  # of each document, and the end
    first_b: np.ndarray
    end_a: np.ndarray  # of each group
    end_b: np.ndarray

    @classmethod
    def of(cls, encoders: Encoders, texts: list[str | None]) -> Aligned:
        a, b, first_a, first_b = [], [], [0], [0]
        for ids_a, ids_b in encoders.encode(texts):
            a.append(ids_a)
            b.append(ids_b)
            first_a.append(first_a[-1] + len(ids_a))
            first_b.append(first_b[-1] + len(ids_b))
        a, b = np.concatenate(a), np.concatenate(b)
        first_a, first_b = np.array(first_a, np.int64), np.array(first_b, np.int64)
        # Documents without tokens have no interval.
        some = np.append(np.diff(first_a) > 0, True)
        ends = groups(
            np.concatenate([[0], np.cumsum(encoders.length_a[a])]),
            np.concatenate([[0], np.cumsum(encoders.length_b[b])]),
            first_a[some],
            first_b[some],
        )
        return cls(a, b, first_a, first_b, *ends)

    @property
    def sizes(self) -> tuple[np.ndarray, np.ndarray]:
        return np.diff(self.end_a, prepend=0), np.diff(self.end_b, prepend=0)

    def first_groups(self) -> np.ndarray:
        """First group of each document, and the number of all groups."""
        return np.searchsorted(self.end_a, self.first_a, "right")

    def texts(self, names: list[str]) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` for each document; ``names`` as made by ``named``."""
        size_a, size_b = self.sizes
        written = np.empty(len(self.a) + len(self.b), np.int64)
        mark_a, mark_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        mark_a[self.end_a - 1], mark_b[self.end_b - 1] = 1, 2
        mark_b[self.first_b[1:][np.diff(self.first_b) > 0] - 1] = 3
        written[np.arange(len(self.a)) + np.repeat(self.end_b - size_b, size_a)] = 4 * self.a + mark_a
        written[np.arange(len(self.b)) + np.repeat(self.end_a, size_b)] = 4 * self.b + mark_b
        bounds = (self.first_a + self.first_b).tolist()
        return ["".join(map(names.__getitem__, written[x:y].tolist())) for x, y in zip(bounds, bounds[1:])]

    def pairs(self, n_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(document, pair, links)``, by document; a pair is ``a * n_b + b``."""
        size_a, size_b = self.sizes
        links = size_a * size_b
        document = np.repeat(np.arange(len(self.first_a) - 1), np.diff(self.first_groups()))
        begin_a, begin_b = self.end_a - size_a, self.end_b - size_b

        small = np.flatnonzero(links <= LARGE_GROUP)
        of = np.repeat(small, links[small])
        place = np.arange(len(of)) - np.repeat(np.cumsum(links[small]) - links[small], links[small])
        row, column = np.divmod(place, size_b[of])
        ids = [self.a[begin_a[of] + row] * n_b + self.b[begin_b[of] + column]]
        documents, weights = [document[of]], [np.ones(len(of), np.int64)]
        for g in np.flatnonzero(links > LARGE_GROUP):
            ids_a, times_a = np.unique(self.a[begin_a[g] : self.end_a[g]], return_counts=True)
            ids_b, times_b = np.unique(self.b[begin_b[g] : self.end_b[g]], return_counts=True)
            ids.append((ids_a[:, None] * n_b + ids_b).ravel())
            weights.append((times_a[:, None] * times_b).ravel())
            documents.append(np.full(len(ids[-1]), document[g]))
        ids, documents, weights = map(np.concatenate, (ids, documents, weights))
        if len(weights) == len(of):  # all weigh 1
            key = np.sort((documents << 32) | ids)
            first = np.flatnonzero(np.diff(key, prepend=-1))
            return key[first] >> 32, key[first] & 0xFFFFFFFF, np.diff(first, append=len(key))
        order = np.lexsort((ids, documents))
        ids, documents, weights = ids[order], documents[order], weights[order]
        first = np.flatnonzero((np.diff(ids, prepend=-1) != 0) | (np.diff(documents, prepend=-1) != 0))
        return documents[first], ids[first], np.add.reduceat(weights, first)


def named(n: int) -> list[str]:
    """Decimal ids, followed by what stands between tokens, groups' halves, groups, and nothing."""
    return [f"{i}{mark}" for i in range(n) for mark in (",", "|", ";", "")]


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    begin, chars = 0, 0
    for k, text in enumerate(texts):
        if chars and chars + len(text or "") > CHUNK_CHARS:
            yield begin, k
            begin, chars = k, 0
        chars += len(text or "")
    if begin < len(texts):
        yield begin, len(texts)


def aligned_documents(
    docs: DataFrame,
    vocabularies: Vocabularies | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: bool = False,
) -> DataFrame:
    """Per document ``row`` (a number of its own), ``id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``,
    ``groups`` (their text, or its SHA-256), ``pairs`` (different pairs as ``a * n_b + b``) and
    ``links`` (how often each is linked)."""
    vocabularies = Vocabularies.read() if vocabularies is None else vocabularies
    if vocabularies.n_a * vocabularies.n_b >= 1 << 32:
        raise ValueError("pairs of ids need more than 32 bits")
    shared = shared_value(docs.sparkSession, vocabularies)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabularies = value_of(shared)
        encoders, names = Encoders(vocabularies), named(max(vocabularies.n_a, vocabularies.n_b))
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for begin, end in _chunks(texts):
                found = Aligned.of(encoders, texts[begin:end])
                first = found.first_groups()
                size_a, size_b = found.sizes
                links = np.concatenate([[0], np.cumsum(size_a * size_b)])
                written_groups = found.texts(names)
                if digest:
                    written_groups = [x and sha256(x.encode()).hexdigest() for x in written_groups]
                document, pair, times = found.pairs(vocabularies.n_b)
                counts = np.bincount(document, minlength=end - begin)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").slice(begin, end - begin),
                        batch.column("id").slice(begin, end - begin),
                        pa.array(np.diff(found.first_a)),
                        pa.array(np.diff(found.first_b)),
                        pa.array(np.diff(first)),
                        pa.array(np.diff(links[first])),
                        pa.array(written_groups, pa.string()),
                        list_array(pair, counts),
                        list_array(times, counts),
                    ],
                    ["row", "id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "links"],
                )

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text")
    )
    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        align,
        f"row long, id {id_type}, n_a long, n_b long, n_groups long, n_links long, groups string, "
        "pairs array<long>, links array<long>",
    )


def pair_counts(aligned: DataFrame, n_b: int) -> DataFrame:
    """``(pair, n, best)``: documents that hold the pair linked, and whether no pair of its A id has more."""
    counts = written(
        aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "token-pairs"
    )
    most = counts.groupBy(F.expr(f"pair div {n_b}").alias("a")).agg(F.max("n").alias("most"))
    # At most as many rows as A has ids.
    marked = counts.join(F.broadcast(most), F.expr(f"pair div {n_b}") == F.col("a"))
    return marked.select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align_tokens(
    docs: DataFrame,
    vocabularies: Vocabularies | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    broadcast_pairs: int = BROADCAST_PAIRS,
    digest: bool = False,
) -> DataFrame:
    """Per document ``id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups``, ``n_best`` (links of
    a pair whose count is the highest of its A id) and ``count_sum`` (counts over all links)."""
    vocabularies = Vocabularies.read() if vocabularies is None else vocabularies
    aligned = written(
        aligned_documents(docs, vocabularies, id_col=id_col, text_col=text_col, digest=digest), "token-alignment"
    )
    counts = written(pair_counts(aligned, vocabularies.n_b), "token-pair-counts")
    small = counts.count() <= broadcast_pairs
    single = aligned.select("row", F.explode(F.arrays_zip("pairs", "links")).alias("x")).select(
        "row", F.col("x.pairs").alias("pair"), F.col("x.links").alias("links")
    )
    sums = (
        single.join(F.broadcast(counts) if small else counts, "pair")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"),
            F.sum(F.col("n") * F.col("links")).alias("count_sum"),
        )
    )
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return aligned.join(sums, "row", "left").select(
        "id", "n_a", "n_b", "n_groups", "n_links", "groups", zero("n_best"), zero("count_sum")
    )
