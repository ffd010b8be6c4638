"""Quality rules by repetition coverage.

How much of a text is repetition within it: the characters of words inside n-grams that the text
holds twice or more, for several n, and the characters of lines that equal an earlier line.
Rolling hashes of all n-grams of a few megabytes of texts are computed and sorted at once in
numpy, with the text's number mixed in; texts are never compared with each other, so nothing is
shuffled, and any text is as long as it is.

Hashes have 64 bits; two different n-grams of one text count as equal if theirs are.

Edge cases: a null or empty text has no words and fails the base rules, as all texts with few
words do; repeated rows get the same result each; other columns are carried along untouched,
and one named like the result is refused.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from watchpost.llm.words import NOT_SPACE, SPACES, Words, chunks, mix, rolling_hashes, split_words, word_hashes

SYMBOLS = np.zeros(256, np.int64)
SYMBOLS[list(b"#*$%&|<>")] = 1
BASE_WIDTH = 3
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# Per cent of the words' characters that repeated n-grams may cover, by n.
MAX_COVERAGE: Mapping[int, int] = {5: 40, 7: 35, 10: 30}
MAX_LINE_PERCENT = 30  # of the text's characters, line ends left out, in repeated lines


def _measures(widths: Sequence[int]) -> T.StructType:
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "dup_line_chars", "line_chars", "n_repeat_words"]
    return T.StructType([T.StructField(n, T.LongType()) for n in [*names, *(f"dup_chars_{w}" for w in widths)]])


def covered_words(words: Words, hashes: np.ndarray, width: int) -> np.ndarray:
    """Which words are inside an n-gram of ``width`` words that their text holds twice or more."""
    text_of = words.text_of
    grams = rolling_hashes(hashes, width)
    begin = np.flatnonzero(text_of[: len(grams)] == text_of[width - 1 :])
    keys = mix(grams[begin] ^ mix(text_of[begin].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edges, begin[twice], 1)
    np.add.at(edges, begin[twice] + width, -1)
    return np.cumsum(edges[:-1]) > 0


def _by_text(words: Words, values: np.ndarray) -> np.ndarray:
    """Sums of the words' values for each text."""
    total = np.r_[0, np.cumsum(values)]
    return total[words.first[1:]] - total[words.first[:-1]]


def repeated_lines(text: bytes) -> tuple[int, int, int]:
    """Lines with a word that equal an earlier line: their number, their characters, and those
    of all lines."""
    lines = text.split(b"\n")
    chars = len(text.decode()) - len(lines) + 1
    if len(lines) == 1:
        return 0, 0, chars
    seen, number, repeated = set(), 0, 0
    for line in lines:
        if line not in seen:
            seen.add(line)
        elif line.strip(SPACES):
            number += 1
            repeated += len(line.decode())
    return number, repeated, chars


def _chunk_measures(data: np.ndarray, offsets: np.ndarray, widths: Sequence[int]) -> np.ndarray:
    words = split_words(data, offsets, NOT_SPACE)
    hashes = word_hashes(words)
    lead = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]  # characters begin with any other byte
    chars = lead[words.end] - lead[words.start]
    symbols = np.r_[0, np.cumsum(SYMBOLS[data])]
    lines = [repeated_lines(data[a:z].tobytes()) for a, z in zip(offsets[:-1], offsets[1:])]
    number, repeated, whole = np.array(lines, np.int64).T
    return np.stack(
        [
            words.counts,
            _by_text(words, chars),
            symbols[offsets[1:]] - symbols[offsets[:-1]],
            number,
            repeated,
            whole,
            _by_text(words, covered_words(words, hashes, BASE_WIDTH)),
            *(_by_text(words, chars * covered_words(words, hashes, width)) for width in widths),
        ]
    )


def measure_repetition(
    docs: DataFrame,
    *,
    text_col: str = "text",
    widths: Sequence[int] = tuple(MAX_COVERAGE),
    measures: str = "repetition",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``docs``, or its columns ``keep``, with a struct column ``measures``.

    Words are separated by ASCII white space, lines by a line feed.

    * ``n_words``, ``word_chars``: words, and the code points in them;
    * ``n_symbols``: characters of ``#*$%&|<>``;
    * ``n_dup_lines``, ``dup_line_chars``, ``line_chars``: lines with a word that equal an earlier
      line, their code points, and those of all lines;
    * ``n_repeat_words``: words in windows of three words that the text holds twice or more;
    * ``dup_chars_N``: code points of the words in such windows of N words.
    """
    if measures in docs.columns:
        raise ValueError(f"the documents already have a column {measures}")
    keep = list(docs.columns if keep is None else keep)
    kind = _measures(widths)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_chunk_measures(data, offsets, widths) for _, data, offsets in chunks(batch.column(text_col))]
            values = np.concatenate(found, axis=1) if found else np.empty((len(kind), 0), np.int64)
            column = pa.StructArray.from_arrays([pa.array(v.astype(np.int64)) for v in values], names=kind.names)
            yield pa.record_batch([*(batch.column(c) for c in keep), column], [*keep, measures])

    return docs.mapInArrow(measure, T.StructType([*(docs.schema[c] for c in keep), T.StructField(measures, kind)]))


def base_failed(measures: str = "repetition"):
    """Too few words, or too many of them in repeated windows of three."""
    n = F.col(f"{measures}.n_words")
    return (n < MIN_WORDS) | (100 * F.col(f"{measures}.n_repeat_words") > MAX_REPEAT_PERCENT * n)


def too_repetitive(
    measures: str = "repetition",
    max_coverage: Mapping[int, int] = MAX_COVERAGE,
    max_line_percent: int = MAX_LINE_PERCENT,
):
    """Repeated n-grams of some length, or repeated lines, cover more than their limit."""
    m = F.col(measures)
    over = 100 * m["dup_line_chars"] > max_line_percent * m["line_chars"]
    for width, percent in max_coverage.items():
        over = over | (100 * m[f"dup_chars_{width}"] > percent * m["word_chars"])
    return over


def without_repetition(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass the base rules and the coverage limits, with their columns."""
    measures = "__repetition"
    measured = measure_repetition(docs, text_col=text_col, measures=measures)
    return measured.where(~base_failed(measures) & ~too_repetitive(measures)).drop(measures)
