"""Licence scans with a positional index of the rarest licence words.

A first pass counts in how many documents each word of the templates occurs; only these words
are counted, so the table is as large as the templates.  A template is then indexed by its words
of highest IDF, with their positions.  The second pass looks up the occurrences of those words in
each whole text and intersects the postings by relative position: where enough rare words of
one template imply beginnings within a few words of each other, the template is compared with that
place, word by word in its order, and its mandatory key phrases must stand there: words put in or
left out don't hide a notice.  Texts are never shuffled.

Edge cases: a null or empty text has no words and no labels; a licence word that no document
holds has the highest IDF and never matches; words of equal IDF are indexed by their order in the
alphabet; equal scores give one score; repeated rows get the same result each; other
columns are carried along untouched, and one named like the result is refused.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from watchpost.llm.licence_templates import BASE_PHRASES, TEMPLATES, Template
from watchpost.llm.words import ALPHANUMERIC, Words, chunks, hash_words, split_words, word_hashes

INDEXED_WORDS = 6  # different rare words by which a template is indexed
AGREEING = 0.5  # of a template's indexed places, for a comparison
SIMILAR = 0.75  # of its words that must stand there in their order
SLACK = 8  # words put in or left out, and around the place in which a key phrase may stand

FOUND_TYPE = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("base_places", T.ArrayType(T.LongType())),
        T.StructField("base_labels", T.ArrayType(T.StringType())),
        T.StructField("labels", T.ArrayType(T.StringType())),
        T.StructField("score", T.DoubleType()),
    ]
)


def words_of(text: str) -> list[bytes]:
    (_, data, offsets), *_ = chunks(pa.array([text]))
    words = split_words(data, offsets, ALPHANUMERIC, lower=True)
    return [words.word(i) for i in range(len(words.start))]


@dataclass
class Index:
    """The templates as numbered words.  Number 0 is any other word."""

    templates: Sequence[Template]
    base_phrases: Sequence[tuple[str, str]]
    vocabulary: list[bytes] = field(init=False)

    def __post_init__(self):
        texts = [t.notice for t in self.templates] + [p for t in self.templates for p in t.key_phrases]
        texts += [p for p, _ in self.base_phrases]
        words = sorted({w for text in texts for w in words_of(text)})
        hashes = hash_words(words)
        order = np.argsort(hashes)
        self.hashes, self.vocabulary = hashes[order], [words[i] for i in order]
        number = {w: i + 1 for i, w in enumerate(self.vocabulary)}
        numbered = lambda text: np.array([number[w] for w in words_of(text)], np.int32)
        self.notices = [numbered(t.notice) for t in self.templates]
        self.keys = [[numbered(p) for p in t.key_phrases] for t in self.templates]
        self.base = [(numbered(p), label) for p, label in self.base_phrases]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        return np.where(self.hashes[at] == hashes, at + 1, 0).astype(np.int32)

    def set_frequencies(self, frequency: dict[int, int], documents: int, indexed: int) -> None:
        """Index each template by its ``indexed`` words of highest IDF."""
        idf = {k + 1: log((1 + documents) / (1 + frequency.get(k + 1, 0))) for k in range(len(self.vocabulary))}
        postings: list[tuple[int, int, int]] = []
        self.places = []
        for t, notice in enumerate(self.notices):
            rare = sorted(set(notice.tolist()), key=lambda w: (-idf[w], w))[:indexed]
            own = [(w, t, place) for place, w in enumerate(notice.tolist()) if w in rare]
            self.places.append(len(own))
            postings += own
        postings.sort()
        self.posting_word, self.posting_template, self.posting_place = np.array(postings, np.int64).T
        edges = np.arange(len(self.vocabulary) + 2)
        self.posting_first = np.searchsorted(self.posting_word, edges)


def _numbered(column: pa.Array, index: Index) -> Iterator[tuple[Words, np.ndarray]]:
    for _, data, offsets in chunks(column):
        words = split_words(data, offsets, ALPHANUMERIC, lower=True)
        yield words, index.numbers(word_hashes(words))


def _frequencies(docs: DataFrame, text_col: str, index: Index) -> tuple[dict[int, int], int]:
    """Documents in which each word of the templates occurs, and all documents (number -1)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(index.vocabulary) + 1, np.int64)
        documents = 0
        for batch in batches:
            documents += batch.num_rows
            for words, numbers in _numbered(batch.column(0), index):
                some = np.flatnonzero(numbers)
                pairs = np.unique(words.text_of[some].astype(np.int64) * len(total) + numbers[some])
                total += np.bincount(pairs % len(total), minlength=len(total))
        yield pa.record_batch([pa.array([-1, *range(len(total))]), pa.array([documents, *total.tolist()])], ["word", "n"])

    counts = docs.select(text_col).mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = {r["word"]: r["n"] for r in counts.collect()}  # a row for each word of the templates
    return found, found.get(-1, 0)


def _phrase_places(numbers: np.ndarray, text_of: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Places at which the phrase's words stand consecutively in one text."""
    n = len(numbers) - len(phrase) + 1
    if n <= 0:
        return np.empty(0, np.int64)
    at = np.flatnonzero(numbers[:n] == phrase[0])
    for k in range(1, len(phrase)):
        at = at[numbers[at + k] == phrase[k]]
    return at[text_of[at] == text_of[at + len(phrase) - 1]]


def _candidates(numbers: np.ndarray, text_of: np.ndarray, index: Index) -> Iterator[tuple[int, int, list[int]]]:
    """``(text, template, beginnings)`` that enough rare words imply together.

    A word put in or left out moves the beginning that the words after it imply, so beginnings
    within ``SLACK`` of each other count together; each may be the first of such a group.
    """
    first = index.posting_first
    places = np.flatnonzero((first[1:] > first[:-1])[numbers] & (numbers > 0)) if len(numbers) else []
    if not len(places):
        return
    own = numbers[places]
    counts = first[own + 1] - first[own]
    posting = np.repeat(first[own] - np.r_[0, np.cumsum(counts)[:-1]], counts) + np.arange(counts.sum())
    template = index.posting_template[posting]
    begin = np.repeat(places, counts) - index.posting_place[posting]
    text = text_of[np.repeat(places, counts)]
    implied, agreeing = np.unique(np.stack([text, template, begin]), axis=1, return_counts=True)
    # One number in the order of text, template and beginning, with room between templates.
    width = int(begin.max() - begin.min()) + 2 * SLACK + 2
    key = (implied[0] * len(index.places) + implied[1]) * width + (implied[2] - begin.min())
    last = np.searchsorted(key, key + SLACK, "right")
    total = np.r_[0, np.cumsum(agreeing)]
    needed = np.array([max(1, ceil(AGREEING * n)) for n in index.places])
    for i in np.flatnonzero(total[last] - total[:-1] >= needed[implied[1]]).tolist():
        yield int(implied[0, i]), int(implied[1, i]), implied[2, i : last[i]].tolist()


def _in_order(words: np.ndarray, notice: np.ndarray) -> int:
    """Most words of the notice that stand among ``words`` in its order (longest common subsequence)."""
    best = np.zeros(len(words) + 1, np.int64)
    for number in notice:
        best[1:] = np.maximum(best[1:], best[:-1] + (words == number))
        np.maximum.accumulate(best, out=best)
    return int(best[-1])


def _scan(words: Words, numbers: np.ndarray, index: Index) -> list[dict]:
    text_of = words.text_of
    results = [
        {"n_words": n, "base_places": [], "base_labels": set(), "labels": set(), "score": 0.0}
        for n in words.counts.tolist()
    ]
    for phrase, label in index.base:
        for at in _phrase_places(numbers, text_of, phrase).tolist():
            result = results[text_of[at]]
            result["base_places"].append(at - int(words.first[text_of[at]]))
            result["base_labels"].add(label)
            result["labels"].add(label)
            result["score"] = 1.0  # a phrase that stands there as it is
    for text, template, begins in _candidates(numbers, text_of, index):
        low, high = int(words.first[text]), int(words.first[text + 1])
        notice = index.notices[template]
        near = numbers[max(low, begins[0] - SLACK) : min(high, begins[-1] + len(notice) + SLACK)]
        score = _in_order(near, notice) / len(notice)
        one = np.zeros(len(near), np.int64)
        if score >= SIMILAR and all(len(_phrase_places(near, one, key)) for key in index.keys[template]):
            results[text]["labels"].add(index.templates[template].label)
            results[text]["score"] = max(results[text]["score"], score)
    for result in results:
        for name in ("base_places", "base_labels", "labels"):
            result[name] = sorted(result[name])
    return results


def scan_licences(
    docs: DataFrame,
    *,
    text_col: str = "text",
    templates: Sequence[Template] = TEMPLATES,
    base_phrases: Sequence[tuple[str, str]] = BASE_PHRASES,
    indexed_words: int = INDEXED_WORDS,
    found: str = "licences",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``docs``, or its columns ``keep``, with a struct column ``found``.

    * ``n_words``: words, which are runs of ASCII letters and digits and of characters above 0x7F;
    * ``base_places``: words at which a base phrase begins, from 0, once for each phrase there;
    * ``base_labels``: labels of those phrases; ``labels``: these and those of matched templates;
    * ``score``: the largest share of a matched template's words in their order; a base phrase
      counts 1, and without any label it is 0.
    """
    if found in docs.columns:
        raise ValueError(f"the documents already have a column {found}")
    keep = list(docs.columns if keep is None else keep)
    index = Index(templates, base_phrases)
    index.set_frequencies(*_frequencies(docs, text_col, index), indexed_words)
    kind = to_arrow_type(FOUND_TYPE)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            results = [r for part in _numbered(batch.column(text_col), index) for r in _scan(*part, index)]
            yield pa.record_batch([*(batch.column(c) for c in keep), pa.array(results, kind)], [*keep, found])

    return docs.mapInArrow(scan, T.StructType([*(docs.schema[c] for c in keep), T.StructField(found, FOUND_TYPE)]))
