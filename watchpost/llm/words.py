"""Words of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow column.

Texts are taken in chunks of a few megabytes, so that the arrays stay small whatever the
batch holds; a text longer than a chunk is a chunk of its own.  A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 4 << 20
LONG_WORD = 48  # bytes; longer words are hashed one by one

# The two word classes, as sets of bytes that belong to a word.  Every byte of
# a multi-byte character is above 0x7F, so a class over bytes is a class over characters.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
NOT_SPACE = np.ones(256, np.uint8)
NOT_SPACE[list(SPACES)] = 0
ALPHANUMERIC = np.zeros(256, np.uint8)
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    ALPHANUMERIC[_low : _high + 1] = 1

LOWER = np.arange(256, dtype=np.uint8)  # A-Z only, other letters stay
LOWER[0x41:0x5B] += 32


@dataclass
class Words:
    """Words of consecutive texts.  Text ``i`` has the words ``first[i]`` to ``first[i + 1]``."""

    data: np.ndarray  # bytes of all texts
    offsets: np.ndarray  # where each text begins in data, and the end of the last
    start: np.ndarray  # of each word in data
    end: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.first) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of(self) -> np.ndarray:
        """Number of the text, for each word."""
        return np.repeat(np.arange(len(self)), self.counts)

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def chunks(column: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Slices of a text column: number of the first text, its bytes, offsets in them."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    begin = 0
    while begin < len(column):
        end = int(np.searchsorted(offsets, offsets[begin] + chunk_bytes, "right")) - 1
        end = min(max(end, begin + 1), len(column))
        yield begin, data[offsets[begin] : offsets[end]], offsets[begin : end + 1] - offsets[begin]
        begin = end


def split_words(data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray, *, lower: bool = False) -> Words:
    """Maximal runs of ``word_bytes`` in each text; no word goes over the end of a text."""
    inside = word_bytes[data]
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]  # where texts that aren't empty begin
    after = np.empty_like(inside)
    after[1:] = inside[:-1]
    after[edges] = 0
    start = np.flatnonzero(inside > after)
    before = after
    before[:-1] = inside[1:]
    before[offsets[1:][offsets[:-1] < offsets[1:]] - 1] = 0
    end = np.flatnonzero(inside > before) + 1
    return Words(LOWER[data] if lower else data, offsets, start, end, np.searchsorted(start, offsets))


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit integers over the whole range; one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: Words) -> np.ndarray:
    """64-bit hash of each word's bytes; the same in every process."""
    length = words.end - words.start
    hashes = length.astype(np.uint64)
    # Longest first, so that the words that still have a byte are those in front.
    sizes = np.where(length > LONG_WORD, 0, length).astype(np.uint8)
    order = np.argsort(LONG_WORD - sizes, kind="stable")
    left = len(words.start) - np.cumsum(np.bincount(sizes, minlength=LONG_WORD))
    at, own = words.start[order], hashes[order]
    for n in left[: int(sizes.max(initial=0))].tolist():
        own[:n] ^= words.data[at[:n]]
        own[:n] *= np.uint64(0x9E3779B97F4A7C15)
        at[:n] += 1
    hashes[order] = own
    for i in np.flatnonzero(length > LONG_WORD):
        hashes[i] = int.from_bytes(blake2b(words.word(i), digest_size=8).digest(), "little")
    return mix(hashes)


def rolling_hashes(items: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive items; shorter by ``width - 1``."""
    n = max(0, len(items) - width + 1)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total = total * np.uint64(0xD6E8FEB86659FD93) + items[k : k + n]
    return mix(total ^ np.uint64(width))


def hash_words(words: list[bytes]) -> np.ndarray:
    """``word_hashes`` of separate words."""
    data = np.frombuffer(b"".join(words), np.uint8)
    offsets = np.cumsum([0, *map(len, words)])
    whole = Words(data, offsets, offsets[:-1], offsets[1:], np.arange(len(words) + 1))
    return word_hashes(whole)
