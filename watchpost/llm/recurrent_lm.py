"""Log-likelihood of documents under a gated recurrent language model trained on the corpus.

Tokens of a text are its words, A-Z lower-cased, then one end.  Documents whose ``crc32`` of the id
is a multiple of ten are held out; everything is learned from the others.

1. **Counts.**  Every word of every training document is counted: tasks count the words of a few
   megabytes at a time, add up those of an Arrow batch, and Spark adds up the rest.  The table of all words is written and never leaves Spark.
2. **Symbols.**  The network predicts at most ``symbols`` most frequent words, the end, and the rest.
   A word of the rest has its smoothed frequency among the rest, and so has the unseen word, so
   that the probabilities of all words sum to 1.
3. **Lookup.**  At most ``lookup`` frequent words of at most 48 bytes, 8 MB, go to the tasks, which
   write each document as symbols, packed in one binary value, sums over known words, and its other words with
   their numbers.
   Only these others, rare words mostly, are joined with the table of all words.
4. **Training.**  Documents are dealt into rounds.  In a round, each task starts from the same
   network and trains it on all its documents, cut into segments of ``segment`` tokens, by truncated
   backpropagation; the networks are averaged, weighted by their tokens, block by block of weights.
   Every training document is used once.  A network is about half a megabyte whatever the corpus.
5. **Scores.**  Each document is run through the network from its first token to its last, many
   documents side by side; states go on across windows.

Nothing is taken from a sample and no document is cut for its score.  Words are told apart by 64-bit
hashes inside a task and by their letters in joins.  Results depend on the number of partitions in
the way training by parts does; the same table and settings give the same model but for rounding in
the order of sums.

Edge cases: a null or empty text has one token, its end; a null id is taken as the empty id, whose
remainder is 0: held out; repeated rows count and score each; without training documents all
probability is with the unseen word; an empty table gives an empty result; other columns aren't
read.  A very long text takes time in proportion to its tokens in one task, as the state does, and
memory for its symbols.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchpost.llm.batches import list_array
from watchpost.llm.recurrent_net import Network, Trainer, lanes, score
from watchpost.llm.storage import shared_value, value_of, written
from watchpost.llm.words import LONG_WORD, NOT_SPACE, Words, chunks, split_words, word_hashes

SMOOTHING = 0.1
FOLDS = 10
BLOCK = 1 << 13  # weights that are averaged together
SALTS = 64
COUNTED_ROWS = 1 << 16  # words that go to Spark at once


@dataclass(frozen=True)
class Settings:
    symbols: int = 2048
    lookup: int = 1 << 17
    hidden: int = 16
    classes: int = 45
    rounds: int = 4
    segment: int = 256
    lanes: int = 512
    steps: int = 16  # of a window of backpropagation
    rate: float = 0.02
    seed: int = 11


@dataclass(frozen=True)
class Vocabulary:
    """What tasks have to know of the words."""

    hashes: np.ndarray  # of frequent words, ascending
    symbol: np.ndarray  # of each, or the rest
    log_count: np.ndarray  # log10(count + smoothing) of each
    counts: np.ndarray  # of the symbols, by falling count
    end: int  # symbol of the end
    end_log: float
    tokens: int  # in training documents
    types: int
    rest_tokens: int
    rest_types: int

    @property
    def rest(self) -> int:
        return len(self.counts)

    @property
    def log_all(self) -> float:
        return float(np.log10(self.tokens + SMOOTHING * (self.types + 1)))

    @property
    def log_rest(self) -> float:
        return float(np.log10(self.rest_tokens + SMOOTHING * (self.rest_types + 1)))


def held_out(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def _strings(words: Words, which: np.ndarray) -> pa.Array:
    """The words of these numbers as an Arrow column."""
    start, length = words.start[which], (words.end - words.start)[which]
    offsets = np.concatenate([[0], np.cumsum(length)])
    data = words.data[np.repeat(start - offsets[:-1], length) + np.arange(offsets[-1])]
    buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data.tobytes())]
    return pa.Array.from_buffers(pa.large_string(), len(which), buffers).cast(pa.string())


def _distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the different hashes, in order of appearance, and where each is first."""
    codes = pa.array(hashes).dictionary_encode().indices.to_numpy()
    first = np.empty(int(codes.max()) + 1 if len(codes) else 0, np.int64)
    first[codes[::-1]] = np.arange(len(codes))[::-1]  # the last to be written is the first
    return codes, first


def count_words(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, n)`` over the documents that aren't held out; the null word is the end."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ends = pa.array([batch.num_rows], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.string()), ends], ["word", "n"])
            parts = []
            for _, data, offsets in chunks(batch.column("text")):
                words = split_words(data, offsets, NOT_SPACE, lower=True)
                codes, first = _distinct(word_hashes(words))
                n = np.bincount(codes, minlength=len(first))
                parts.append(pa.RecordBatch.from_arrays([_strings(words, first), pa.array(n)], ["word", "n"]))
            if parts:  # a frequent word is in every chunk, and goes to Spark once
                both = pa.Table.from_batches(parts).group_by("word", use_threads=False).aggregate([("n", "sum")])
                for part in both.select(["word", "n_sum"]).to_batches(max_chunksize=COUNTED_ROWS):
                    yield part.rename_columns(["word", "n"])

    texts = docs.where(~held_out(F.col(id_col))).select(F.col(text_col).alias("text"))
    return texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary_of(words: DataFrame, settings: Settings) -> Vocabulary:
    """From ``count_words``, written; at most ``lookup`` words go to the driver."""
    # Eighths of powers of two: a few hundred rows say from which count on the words are few enough.
    level = F.floor(8 * F.log2("n")).cast("int")
    levels = words.groupBy(level.alias("level")).agg(F.count("*").alias("types"), F.sum("n").alias("n")).collect()
    tokens, types = sum(r.n for r in levels), sum(r.types for r in levels)
    lowest, taken = 1 << 20, 0
    for r in sorted(levels, reverse=True):
        taken += r.types
        if taken > settings.lookup:
            break
        lowest = r.level
    short = F.col("word").isNull() | (F.octet_length("word") <= LONG_WORD)
    rows = words.where((level >= lowest) & short).collect()
    frequent = sorted(((r.word, r.n) for r in rows if r.word is not None), key=lambda x: (-x[1], x[0]))
    ends = words.where("word is null").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    chosen = sorted([(None, ends), *frequent[: settings.symbols - 1]], key=lambda x: (-x[1], x[0] or ""))
    counts = np.array([n for _, n in chosen], np.float64)
    number = {word: i for i, (word, _) in enumerate(chosen)}
    encoded = [word.encode() for word, _ in frequent]
    bounds = np.cumsum([0, *map(len, encoded)])
    data = np.frombuffer(b"".join(encoded), np.uint8)
    hashes = word_hashes(Words(data, bounds, bounds[:-1], bounds[1:], np.arange(len(encoded) + 1)))
    order = np.argsort(hashes)
    symbol = np.array([number.get(word, len(chosen)) for word, _ in frequent], np.int64)
    log_count = np.log10(np.array([n for _, n in frequent], np.float64) + SMOOTHING)
    return Vocabulary(
        hashes[order],
        symbol[order],
        log_count[order],
        counts,
        number[None],
        float(np.log10(ends + SMOOTHING)),
        tokens,
        types,
        int(tokens - counts.sum()),
        types - int((counts > 0).sum()),
    )


def _packed(symbols: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Each text's symbols, two bytes each, as one value: Spark then writes and reads them by the text."""
    offsets = pa.array(np.concatenate([[0], np.cumsum(2 * counts)]).astype(np.int32))
    data = pa.py_buffer(symbols.astype("<i2").tobytes())
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, offsets.buffers()[1], data])


def _encode_chunk(words: Words, vocabulary: Vocabulary) -> list[pa.Array]:
    n, of = len(words), words.text_of
    codes, at_first = _distinct(hashes := word_hashes(words))
    # Each different word is looked up once.
    asked = hashes[at_first]
    found, symbol, log = np.zeros(len(asked), bool), np.full(len(asked), vocabulary.rest), np.zeros(len(asked))
    if len(vocabulary.hashes):
        at = np.minimum(np.searchsorted(vocabulary.hashes, asked), len(vocabulary.hashes) - 1)
        found = vocabulary.hashes[at] == asked
        symbol[found], log[found] = vocabulary.symbol[at[found]], vocabulary.log_count[at[found]]
    known, symbols, logs = found[codes], symbol[codes], log[codes]
    in_rest = symbols == vocabulary.rest
    sums = lambda x: np.bincount(of, x, minlength=n).astype(float)  # noqa: E731 (without words it has integers)

    # Symbols with an end after each text.
    counts = words.counts
    whole = np.full(len(symbols) + n, vocabulary.end, np.int16)
    whole[np.arange(len(symbols)) + of] = symbols

    others = np.flatnonzero(~known)
    key = of[others] * len(asked) + codes[others]
    order = np.argsort(key)
    others = others[order]
    first = np.flatnonzero(np.diff(key[order], prepend=-1))
    times = np.diff(np.append(first, len(others)))
    per_text = np.bincount(of[others[first]], minlength=n)
    offsets = pa.array(np.concatenate([[0], np.cumsum(per_text)]).astype(np.int32))
    return [
        pa.array(counts + 1),
        pa.array((sums(known) + (vocabulary.counts[vocabulary.end] > 0)).astype(np.int64)),
        pa.array(sums(in_rest).astype(np.int64)),
        pa.array(sums(logs) + vocabulary.end_log),
        pa.array(sums(np.where(in_rest, logs, 0.0))),
        _packed(whole, counts + 1),
        pa.ListArray.from_arrays(offsets, _strings(words, others[first])),
        list_array(times.astype(np.int32), per_text),
    ]


def encoded(
    docs: DataFrame, vocabulary: Broadcast, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document its ``row``, ``id``, ``held_out``, sums over looked-up tokens, ``symbols``, and the
    ``others`` with how often each occurs (``times``)."""
    names = ["n_tokens", "known", "n_rest", "log_known", "log_rest", "symbols", "others", "times"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = value_of(vocabulary)
        for batch in batches:
            for begin, data, offsets in chunks(batch.column("text")):
                words = split_words(data, offsets, NOT_SPACE, lower=True)
                kept = [batch.column(c).slice(begin, len(words)) for c in ("row", "id", "held_out")]
                arrays = [*kept, *_encode_chunk(words, known)]
                yield pa.RecordBatch.from_arrays(arrays, ["row", "id", "held_out", *names])

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        held_out(F.col(id_col)).alias("held_out"),
        F.col(text_col).alias("text"),
    )
    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        encode,
        f"row long, id {id_type}, held_out boolean, n_tokens long, known long, n_rest long, log_known double, "
        "log_rest double, symbols binary, others array<string>, times array<int>",
    )


def _symbols(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All symbols of a batch, where its documents begin, and how long they are."""
    column = batch.column("symbols").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    ends = (offsets - offsets[0]) // 2
    return data.view("<i2").astype(np.int64), ends[:-1], np.diff(ends)


def _segments(begin: np.ndarray, length: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    parts = -(-length // longest)
    of = np.repeat(np.arange(len(length)), parts)
    at = (np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)) * longest
    return begin[of] + at, np.minimum(length[of] - at, longest)


def _summed(models: DataFrame, *keys: str) -> DataFrame:
    """Adds up blocks of weights with equal keys as they stream by; a task holds a sum for each key."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                values = np.frombuffer(row["total"], np.float64)
                own = sums.setdefault((row["block"], row["salt"]), [0, np.zeros(len(values))])
                own[0] += row["tokens"]
                own[1] += values
        for (block, salt), (tokens, values) in sums.items():
            yield pa.RecordBatch.from_pylist(
                [{"block": block, "salt": salt, "tokens": tokens, "total": values.tobytes()}], _MODEL
            )

    return models.repartition(*keys).mapInArrow(add, _MODEL_DDL)


_MODEL_DDL = "block int, salt int, tokens long, total binary"
_MODEL = pa.schema([("block", pa.int32()), ("salt", pa.int32()), ("tokens", pa.int64()), ("total", pa.binary())])


def trained_round(documents: DataFrame, network: Network, end: int, settings: Settings, rate: float) -> Network:
    """The average of the networks that tasks have trained on their documents."""
    start = shared_value(documents.sparkSession, network)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, tokens = Trainer(value_of(start), steps=settings.steps, rate=rate), 0
        for number, batch in enumerate(batches):
            symbols, begin, length = _symbols(batch)
            groups = list(lanes(symbols, *_segments(begin, length, settings.segment), settings.lanes, end))
            np.random.default_rng([settings.seed, number]).shuffle(groups)
            for group in groups:
                trainer.train(group)
            tokens += len(symbols)
        if not tokens:
            return
        values = trainer.network.flat().astype(np.float64) * tokens
        salt = TaskContext.get().partitionId() % SALTS
        for block, at in enumerate(range(0, len(values), BLOCK)):
            row = {"block": block, "salt": salt, "tokens": tokens, "total": values[at : at + BLOCK].tobytes()}
            yield pa.RecordBatch.from_pylist([row], _MODEL)

    models = documents.select("symbols").mapInArrow(train, _MODEL_DDL)
    salted = _summed(models, "block", "salt").withColumn("salt", F.lit(0))
    blocks = sorted(_summed(salted, "block").collect())  # all weights once
    start.unpersist()
    if not blocks:
        return network
    return network.with_flat(np.concatenate([np.frombuffer(r.total, np.float64) / r.tokens for r in blocks]))


def trained(documents: DataFrame, vocabulary: Vocabulary, settings: Settings) -> Network:
    """The network after all rounds; ``documents`` as made by ``encoded``, written."""
    network = Network.new(
        vocabulary.counts,
        vocabulary.rest_tokens,
        hidden=settings.hidden,
        classes=settings.classes,
        seed=settings.seed,
    )
    dealt = F.pmod(F.xxhash64("row"), F.lit(settings.rounds))
    for r in range(settings.rounds):
        part = documents.where(~F.col("held_out") & (dealt == r))
        network = trained_round(part, network, vocabulary.end, settings, settings.rate / (1 + r))
    return network


def scored(documents: DataFrame, network: Network, end: int) -> DataFrame:
    """``documents`` without symbols, and ``log_symbols``: log10 of the probability of all symbols."""
    carried = [c for c in documents.columns if c not in ("symbols", "others", "times")]
    shared = shared_value(documents.sparkSession, network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = value_of(shared)
        for batch in batches:
            symbols, begin, length = _symbols(batch)
            if not len(symbols):
                continue
            # Every document has an end, so none is empty.
            sums = np.add.reduceat(score(network, symbols, begin, length, end), begin) / np.log(10)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carried), pa.array(sums)], [*carried, "log_symbols"]
            )

    schema = ", ".join(f"{c} {t}" for c, t in documents.select(carried).dtypes)
    return documents.select(*carried, "symbols").mapInArrow(run, f"{schema}, log_symbols double")


def score_documents(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    settings: Settings | None = None,
) -> DataFrame:
    """Per document ``id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and
    ``score``: log10 of the text's probability under smoothed frequencies and under the model."""
    settings = settings or Settings()
    words = written(count_words(docs, id_col=id_col, text_col=text_col), "lm-words")
    vocabulary = vocabulary_of(words, settings)
    shared = shared_value(docs.sparkSession, vocabulary)
    documents = written(encoded(docs, shared, id_col=id_col, text_col=text_col), "lm-documents")
    network = trained(documents, vocabulary, settings)

    other = documents.select("row", F.explode(F.arrays_zip("others", "times")).alias("x")).select(
        "row", F.col("x.others").alias("word"), F.col("x.times").alias("times")
    )
    count = F.coalesce(F.col("n"), F.lit(0))
    sums = (
        # Each word is once on the right, so its part of a hash table has no hot key and needs no order.
        other.join(words.hint("shuffle_hash"), "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.log10(count + SMOOTHING)).alias("log_other"),
            F.sum(F.when(count > 0, F.col("times")).otherwise(0)).alias("known_other"),
        )
    )
    log_other = F.coalesce(F.col("log_other"), F.lit(0.0))
    both = scored(documents, network, vocabulary.end).join(sums, "row", "left")
    return both.select(
        "id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce(F.col("known_other"), F.lit(0))).alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("log_known") + log_other - F.col("n_tokens") * vocabulary.log_all).alias("base_score"),
        (F.col("log_symbols") + F.col("log_rest") + log_other - F.col("n_rest") * vocabulary.log_rest).alias("score"),
    )
