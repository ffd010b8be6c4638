"""Benchmark decontamination with suffix arrays of the training texts.

Each task cuts its documents into shards of a few megabytes of text and builds a suffix array over
each: the shard's places, ordered by the words that follow.  Every suffix of every benchmark item
is then binary-searched in the array, all suffixes at once and word by word, which narrows its
interval of places to those that agree with it in one word more.  The intervals that are left
after a whole window are the window's occurrences; each is extended to the longest verbatim
match.  Nothing is shuffled: documents stay where they are read.

The array is sparse: a place at which no match can begin, because one of the words that every
window covers there isn't a benchmark word, isn't in it.

The benchmark is the query set, repeated rows left out.  One that has more than ``BLOCK_BYTES`` of
text is dealt by item over blocks of about half that, each broadcast by itself; what has been found is
written after each block, so that one block at a time is in memory, and documents carry it on.

Edge cases: a null or empty text has no words: as a document it is never hit, as an item it
matches nothing.  An item with a null ``item_id`` marks words but isn't listed.  Rows with the
same ``item_id`` are one item with the windows of both.  Repeated document rows are each
returned.  Other columns of the documents are carried along untouched; one that is named like the
result is refused, and the result can be given another name.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from watchpost.llm.storage import shared_value, value_of, written
from watchpost.llm.words import ALPHANUMERIC, chunks, hash_words, split_words, word_hashes

WINDOW = 10
BLOCK_BYTES = 16 << 20
DEPTH = 16  # words by which the array is ordered; longer matches are extended word by word

MATCH_TYPE = T.StructType(
    [T.StructField("item_id", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("length", T.IntegerType())]
)
FOUND_TYPE = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("hits", T.BinaryType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("matches", T.ArrayType(MATCH_TYPE)),
    ]
)


@dataclass
class Suffixes:
    """The benchmark items of a block as numbered words, one after the other."""

    vocabulary: np.ndarray  # sorted hashes; the word's number is its place, from 1
    words: np.ndarray  # numbers, 0 after each item
    window: np.ndarray  # of each suffix: words of a window that begins there, 0 if none does
    item: np.ndarray  # of each suffix: place in ids
    ids: list[str | None]

    @classmethod
    def of(cls, ids: list[str | None], texts: list[str | None], width: int) -> Suffixes:
        split: list[list[bytes]] = []
        for begin, data, offsets in chunks(pa.array(texts, pa.large_string())):
            found = split_words(data, offsets, ALPHANUMERIC, lower=True)
            split += [[found.word(k) for k in range(a, z)] for a, z in zip(found.first[:-1], found.first[1:])]
        flat = [w for item in split for w in item]
        hashes = hash_words(flat) if flat else np.empty(0, np.uint64)
        vocabulary = np.unique(hashes)
        numbers = np.searchsorted(vocabulary, hashes).astype(np.int32) + 1
        words, window, item, at = [], [], [], 0
        for i, own in enumerate(split):
            size = min(width, len(own))
            words += [*numbers[at : at + len(own)].tolist(), 0]
            window += [size if k + size <= len(own) else 0 for k in range(len(own))] + [0]
            item += [i] * (len(own) + 1)
            at += len(own)
        pad = [0] * max(width, DEPTH)
        return cls(
            vocabulary,
            np.array(words + pad, np.int32),
            np.array(window + pad, np.int32),
            np.array(item + [0] * len(pad), np.int32),
            ids,
        )

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int32)
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == hashes, at + 1, 0).astype(np.int32)


def suffix_array(words: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """``places`` in the order of the ``depth`` words that follow each.

    Words are small numbers, so that several make one 64-bit sort key.  What follows the zero
    at a text's end has a part in the order too, which no search notices: it never passes a zero.
    """
    bits = max(1, int(words.max(initial=0)).bit_length())
    each = 63 // bits
    keys = []
    for begin in range(0, depth, each):
        key = np.zeros(len(places), np.int64)
        for k in range(begin, min(begin + each, depth)):
            key = (key << bits) | words[places + k]
        keys.append(key)
    return places[np.lexsort(keys[::-1])]


def search(words: np.ndarray, array: np.ndarray, suffixes: Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """``(place, suffix)`` of all occurrences of windows, by binary search of every suffix."""
    active = np.flatnonzero(suffixes.window)
    low = np.zeros(len(active), np.int64)
    high = np.full(len(active), len(array), np.int64)
    for k in range(int(suffixes.window.max(initial=0))):
        wanted = suffixes.words[active + k]
        deeper = suffixes.window[active] > k
        for bound, above in ((0, False), (1, True)):
            # First place in [low, high) whose word k is not below, or is above, the wanted one.
            a, z = low.copy(), high.copy()
            while (open_ := (a < z) & deeper).any():
                middle = (a + z) >> 1
                word = words[array[np.minimum(middle, len(array) - 1)] + k]
                right = open_ & ((word <= wanted) if above else (word < wanted))
                a = np.where(right, middle + 1, a)
                z = np.where(open_ & ~right, middle, z)
            if bound == 0:
                begin = np.where(deeper, a, low)
            else:
                high = np.where(deeper, a, high)
        low = begin
        left = low < high
        active, low, high = active[left], low[left], high[left]
    counts = high - low
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return array[np.repeat(low, counts) + within], np.repeat(active, counts)


def longest(words: np.ndarray, place: np.ndarray, suffix: np.ndarray, suffixes: Suffixes) -> np.ndarray:
    """Words that agree from each occurrence on."""
    length = suffixes.window[suffix].astype(np.int64)
    active = np.arange(len(place))
    while len(active):
        p, s = place[active] + length[active], suffix[active] + length[active]
        p, s = np.minimum(p, len(words) - 1), np.minimum(s, len(suffixes.words) - 1)
        active = active[(words[p] == suffixes.words[s]) & (words[p] != 0)]
        length[active] += 1
    return length


def _match_shard(numbers: np.ndarray, text_of: np.ndarray, first: np.ndarray, suffixes: Suffixes):
    """Occurrences in one shard: text, place in it, suffix, and longest match.

    ``numbers`` are the words of all its texts without separators.
    """
    # A zero after each text, and enough at the end for any look ahead.
    depth = pad = max(DEPTH, int(suffixes.window.max(initial=0)))
    at = np.arange(len(numbers)) + text_of
    words = np.zeros(len(numbers) + len(first) + pad, np.int32)
    words[at] = numbers
    least = int(suffixes.window[suffixes.window > 0].min(initial=pad))
    possible = words[: len(words) - pad] > 0
    for k in range(1, least):
        possible &= words[k : len(words) - pad + k] > 0
    places = np.flatnonzero(possible)
    if not len(places):
        return None
    place, suffix = search(words, suffix_array(words, places, depth), suffixes)
    length = longest(words, place, suffix, suffixes)
    text = np.searchsorted(first[1:-1] + np.arange(1, len(first) - 1), place, "right")
    return text, place - first[text] - text, suffix, length


def _find(docs: DataFrame, block: DataFrame, *, text_col: str, width: int, found: str, keep: Sequence[str]):
    """The columns ``keep`` and ``found``, and the block's broadcast; what an earlier block has found
    is added to."""
    items = [(r["item_id"], r["text"]) for r in block.toLocalIterator()]  # a block has a fixed size
    query = Suffixes.of([i for i, _ in items], [t for _, t in items], width)
    shared = shared_value(docs.sparkSession, query)
    later = found in docs.columns

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suffixes = value_of(shared)
        for batch in batches:
            earlier = batch.column(found).to_pylist() if later else [None] * batch.num_rows
            results: list[dict] = []
            for _, data, offsets in chunks(batch.column(text_col)):
                words = split_words(data, offsets, ALPHANUMERIC, lower=True)
                numbers = suffixes.numbers(word_hashes(words))
                matched = _match_shard(numbers, words.text_of, words.first, suffixes)
                by_text: dict[int, list[int]] = {}
                for row, text in enumerate(matched[0].tolist() if matched else ()):
                    by_text.setdefault(text, []).append(row)
                for i, n in enumerate(words.counts.tolist()):
                    rows = [x[by_text[i]] for x in matched[1:]] if i in by_text else None
                    results.append(_result(n, earlier[len(results)], rows, suffixes))
            column = pa.array(results, _FOUND)
            yield pa.record_batch([*(batch.column(c) for c in keep), column], [*keep, found])

    fields = [docs.schema[c] for c in keep]
    return docs.mapInArrow(match, T.StructType([*fields, T.StructField(found, FOUND_TYPE)])), shared


_FOUND = to_arrow_type(FOUND_TYPE)


def _result(n: int, before: dict | None, rows: list[np.ndarray] | None, suffixes: Suffixes) -> dict:
    result = before or {"n_words": n, "n_hit": 0, "hits": None, "items": [], "matches": []}
    if rows is None:
        return result
    place, suffix, length = rows
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, place, 1)
    np.add.at(edges, place + suffixes.window[suffix], -1)
    hit = np.cumsum(edges[:-1]) > 0
    if result["hits"] is not None:
        hit |= np.unpackbits(np.frombuffer(result["hits"], np.uint8), count=n).astype(bool)
    items = {suffixes.ids[i] for i in np.unique(suffixes.item[suffix]).tolist()} - {None}
    at = list(zip(place.tolist(), suffix.tolist(), length.tolist()))
    inner = {(p + 1, s + 1) for p, s, _ in at}  # these go on a match that began before
    matches = [
        {"item_id": suffixes.ids[suffixes.item[s]], "start": p, "length": size}
        for p, s, size in sorted(at)
        if (p, s) not in inner
    ]
    return {
        "n_words": n,
        "n_hit": int(hit.sum()),
        "hits": np.packbits(hit).tobytes(),
        "items": sorted(items | set(result["items"])),
        "matches": result["matches"] + matches,
    }


def benchmark_blocks(benchmark: DataFrame, *, id_col: str, text_col: str, block_bytes: int) -> list[DataFrame]:
    """The benchmark in blocks of about ``block_bytes`` at most, dealt by item; one longer item is a
    block.  Rows that repeat an item count once, so that they don't fill a block."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).alias("text")).distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    number = -(-size // block_bytes) * 2 if size > block_bytes else 1
    if number == 1:
        return [items]
    return [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(number)) == k) for k in range(number)]


def match_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = WINDOW,
    found: str = "benchmark_matches",
    keep: Sequence[str] | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs``, or its columns ``keep``, with a struct column ``found``.

    A window is ``width`` consecutive words of an item, or all words of a shorter one; words are
    runs of ASCII letters and digits and of characters above 0x7F, ASCII letters lower-cased.

    * ``n_words``: words of the document;
    * ``n_hit``, ``hits``: how many words are inside any occurrence of a window, and a bit for
      each word that says which; null bits where none is;
    * ``items``: the different ids of the items with an occurrence, sorted as strings;
    * ``matches``: the longest verbatim matches: item, first word, number of words.
    """
    if found in docs.columns:
        raise ValueError(f"the documents already have a column {found}")
    keep = list(docs.columns if keep is None else keep)
    blocks = benchmark_blocks(benchmark, id_col=item_col, text_col=item_text_col, block_bytes=block_bytes)
    for k, block in enumerate(blocks):
        last = k == len(blocks) - 1
        columns = keep if last else list(dict.fromkeys([*keep, text_col]))
        docs, shared = _find(docs, block, text_col=text_col, width=width, found=found, keep=columns)
        if not last:  # one block at a time is in memory
            docs = written(docs, "benchmark-matches")
            shared.unpersist()
    return docs


def without_benchmark(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark window, with their columns."""
    found = "__benchmark_matches"
    return match_benchmark(docs, benchmark, found=found, **options).where(f"{found}.n_hit = 0").drop(found)
