"""Mixing sources to target weights.

The words of every source are summed (map-side combine, so a source with a third of all rows is
no problem), targets are derived from the sums, and each source gets a repetition rate: target
divided by its words.  A document is then emitted ``floor(rate)`` times, and once more with the
fraction as probability: a hash of the row and the seed is compared with the fraction, so reruns
and retried tasks decide alike.  Equal rows are numbered and draw on their own, so that a source
made of one row many times comes near its target, too.

The table of sources is written; whether it is small enough to broadcast is left to Spark, which
knows the size of its files.  A larger one is joined by shuffle, hot sources split by Spark.

Targets: sources, by code point and null last, weigh 5, 2, 1, repeating.  They share a multiple
of all words by weight; a source above a multiple of its own words stops there, and the excess is
shared by weight again until none is above.  Each step is one aggregate over the sources.

Edge cases: a null text has no words; a source without words has the target and rate 0; a null
source is a source; rows that repeat, in part or as a whole, draw each on their own; a very long
text is counted where it is; sources can't tie, as their order is by code point; other columns, of
types that Spark can hash and group by, are carried along untouched; ``with_copies`` refuses one that
is named like a result, ``mixed`` keeps it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchpost.llm.ranking import repeated
from watchpost.llm.storage import written

WEIGHTS = (5, 2, 1)
SHARE = (3, 2)  # of all words, as a fraction: 150 %
MOST = 2  # times a source's own words
SEED = 17
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Runs of characters other than ASCII white space; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    docs: DataFrame,
    *,
    source_col: str = "source",
    text_col: str = "text",
    weights: Sequence[int] = WEIGHTS,
    share: tuple[int, int] = SHARE,
    most: int = MOST,
) -> DataFrame:
    """``(source, source_size, target, rate)``, a row for each source."""
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(F.sum(n_words(F.col(text_col))).alias("source_size"))
    # A row for each source, not for each document, is ordered here.
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    sources = written(sizes.withColumn("weight", weight.cast("long")), "mixing-sources")
    whole = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]

    # share * whole = top / bottom; sums stay whole numbers, so that no order of adding matters.
    top, bottom = share[0] * whole, share[1]
    stopped = F.lit(False)
    number = -1
    while True:
        full, free, stops = sources.agg(
            F.coalesce(F.sum(F.when(stopped, F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~stopped, F.col("weight"))), F.lit(0)),
            F.count(F.when(stopped, 1)),
        ).first()
        rest = top - bottom * most * full
        if stops == number or not free:
            break
        number = stops
        # target > most * size, with the target as rest * weight / (bottom * free)
        over = F.lit(float(rest)) * F.col("weight") > F.lit(float(bottom * free * most)) * F.col("source_size")
        stopped = stopped | over
    shared = F.lit(float(rest)) / F.lit(float(bottom)) * F.col("weight") / F.lit(float(free or 1))
    target = F.when(stopped, F.lit(float(most)) * F.col("source_size")).otherwise(shared)
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0)
    return sources.select("source", "source_size", target.alias("target"), rate.alias("rate"))


def copies(rate: Column, key: Sequence[Column], seed: int = SEED) -> Column:
    """``floor(rate)``, and one more with the fraction as probability, decided by a hash of the key."""
    # 53 bits of the hash, the precision of a double, as a number from 0 to below 1.
    drawn = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *key), 11) / F.lit(float(1 << 53))
    return (F.floor(rate) + (drawn < rate - F.floor(rate)).cast("long")).cast("long")


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__key``, a hash of the whole row, and ``__number``, from 1 among equal rows.

    Rows that repeat are counted in their tasks before they are shuffled; all others stay where they
    are.  The table of repeated keys is written, so that Spark knows its size and broadcasts it only
    if it is small.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.withColumn("__key", F.xxhash64(*columns))
    counts = rows.groupBy("__key").agg(F.count("*").alias("n")).where("n > 1")
    several = written(counts.select("__key"), "mixing-repeats")
    one = F.lit(1).cast("long").alias("__number")
    if several.isEmpty():
        return rows.select("*", one)
    single = rows.join(several, "__key", "left_anti").select("__key", *columns, one)
    equal = rows.join(several, "__key", "left_semi").groupBy("__key", *columns).agg(F.count("*").alias("__rows"))
    return single.unionByName(repeated(equal, "__rows", "__number").drop("__rows"))


def _drawn(docs: DataFrame, targets: DataFrame, source_col: str, seed: int) -> DataFrame:
    """``docs`` with ``__source_size``, ``__target``, ``__rate`` and ``__copies``."""
    own = targets.select(*[F.col(c).alias(f"__{c}") for c in ("source", "source_size", "target", "rate")])
    return (
        _numbered(docs)
        .join(own, F.col(source_col).eqNullSafe(F.col("__source")))
        .withColumn("__copies", copies(F.col("__rate"), [F.col("__key"), F.col("__number")], seed))
        .drop("__source", "__key", "__number")
    )


def with_copies(
    docs: DataFrame, targets: DataFrame, *, source_col: str = "source", seed: int = SEED
) -> DataFrame:
    """``docs`` with the columns of their source's target and ``copies``; a row stays a row."""
    results = ("source_size", "target", "rate", "copies")
    clash = set(results) & set(docs.columns)
    if clash:
        raise ValueError(f"the documents already have columns {sorted(clash)}")
    return _drawn(docs, targets, source_col, seed).withColumnsRenamed({f"__{c}": c for c in results})


def mixed(
    docs: DataFrame, targets: DataFrame | None = None, *, source_col: str = "source", text_col: str = "text", seed: int = SEED
) -> DataFrame:
    """The mix: every document as many times as its rate says, with the columns of ``docs``."""
    if targets is None:
        targets = source_targets(docs, source_col=source_col, text_col=text_col)
    drawn = _drawn(docs, targets, source_col, seed)
    times = F.explode(F.array_repeat(F.lit(0), F.col("__copies").cast("int")))
    return drawn.withColumn("__copy", times).select(*[F.col(f"`{c}`") for c in docs.columns])
