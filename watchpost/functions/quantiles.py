"""Exact interpolated percentiles without holding a column in one task.

``percentile()`` merges a map of all distinct values into a single task, which cannot
hold a column of doubles at 100 TB.  Here the column becomes a histogram spread over the
cluster.  The range of its values is cut into a fixed number of cells; running totals over
the cells show which cell holds each wanted rank; the values of only those cells are cut in
the same way, by the range that they have, and what is left in the cell that is hit then is
ordered value by value.  So two windows see at most ``CELLS`` + 2 rows for each measure or
cell hit, whatever the number and the span of the values, and the last one the different values
within a part in 2^32 of the range, unless outliers take most of it twice over.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELLS = 1 << 16


def percentiles(
    df: DataFrame,
    measures: Mapping[str, str],
    probabilities: Mapping[str, float],
    *,
    cells: int = CELLS,
    accuracy: int | None = None,
) -> DataFrame:
    """One row per measure: ``measure``, one column per probability, ``mean``.

    ``measures`` maps a label to a column name, ``probabilities`` an output name to a
    value in [0, 1].  NULLs are ignored, NaN ranks above infinity; a measure without values yields NULLs.  With
    ``accuracy`` the sketch ``approx_percentile`` is used instead (rank error at most
    1/accuracy of the rows, one pass, constant memory).
    """
    values = _unpivot(df, measures)
    if accuracy is None:
        found = _exact(values, probabilities, cells)
    else:
        found = _approximate(values, probabilities, accuracy)
    labels = F.array(*[F.lit(label) for label in measures])
    listed = df.sparkSession.range(1).select(F.explode(labels).alias("measure"))
    return listed.join(found, "measure", "left").select("measure", *probabilities, "mean")


def _unpivot(df: DataFrame, measures: Mapping[str, str]) -> DataFrame:
    pairs = [
        F.struct(F.lit(label).alias("measure"), F.col(name).cast("double").alias("value"))
        for label, name in measures.items()
    ]
    return df.select(F.inline(F.array(*pairs)))


def _approximate(values: DataFrame, probabilities: Mapping[str, float], accuracy: int) -> DataFrame:
    sketch = F.approx_percentile("value", list(probabilities.values()), accuracy)
    grouped = values.groupBy("measure").agg(sketch.alias("found"), F.avg("value").alias("mean"))
    columns = [F.col("found")[i].alias(name) for i, name in enumerate(probabilities)]
    return grouped.select("measure", *columns, "mean")


def _exact(values: DataFrame, probabilities: Mapping[str, float], cells: int) -> DataFrame:
    # Every use of the histogram below reads all its columns, and the joins find their filters
    # already there, so that one shuffle serves all.
    known = values.where("value is not null and measure is not null")
    histogram = known.groupBy("measure", "value").agg(F.count(F.lit(1)).alias("n"))
    spans = histogram.groupBy("measure").agg(
        *_span(),
        F.sum("n").alias("total"),
        (_mass(F.col("value"), F.col("n")).cast("double") / F.sum("n")).alias("mean"),
    )
    # Broadcasts here have at most 2 x probabilities x measures rows: a fixed bound.
    celled = _in_cells(histogram, F.broadcast(spans.select("measure", "low", "high")), ["measure"], "cell", cells)
    targets = _narrowed(celled, _ranks(spans, probabilities), ["measure"], "cell")

    group = ["measure", "cell"]
    inner = celled.join(F.broadcast(targets.select(*group)), group, "left_semi")
    inner = _in_cells(inner, F.broadcast(inner.groupBy(*group).agg(*_span())), group, "part", cells)
    targets = _narrowed(inner, targets, group, "part")

    # What is left, ordered once; every rank that falls into a part finds its value there.
    left = inner.join(F.broadcast(targets.select(*group, "part")), [*group, "part"], "left_semi")
    hits = _hits(left, targets, [*group, "part"], "value")

    def at(prob: int, edge: str) -> Column:
        return F.max(F.when((F.col("prob") == prob) & (F.col("edge") == edge), F.col("value")))

    interpolated = []
    for prob, (name, p) in enumerate(probabilities.items()):
        position = (F.max("total") - 1) * F.lit(float(p))
        weight = position - F.floor(position)
        low, high = at(prob, "low"), at(prob, "high")
        # Equal neighbours, also infinite ones, need no interpolation.
        interpolated.append(F.when(low == high, low).otherwise(low + (high - low) * weight).alias(name))
    return hits.groupBy("measure").agg(*interpolated, F.max("mean").alias("mean"))


def _finite(value: Column) -> Column:
    return ~F.isnan(value) & (F.abs(value) < float("inf"))


def _span() -> list[Column]:
    """Aggregates: the range of the finite values.

    ``n`` is never 0; it is asked for so that the histogram is the same as where it is counted.
    """
    value = F.when(_finite(F.col("value")) & (F.col("n") > 0), F.col("value"))
    return [F.min(value).alias("low"), F.max(value).alias("high")]


def _in_cells(rows: DataFrame, spans: DataFrame, group: list[str], name: str, cells: int) -> DataFrame:
    """Rows with the number of their cell: 0 to ``cells - 1`` by value, -1 and ``cells`` for what is
    infinite or no number."""
    value, low, high = F.col("value"), F.col("low"), F.col("high")
    # Halves, because the whole width may be too large for a double.
    share = (value / 2 - low / 2) / F.nullif(high / 2 - low / 2, F.lit(0.0))
    inside = F.least(F.coalesce(F.floor(share * cells), F.lit(0)), F.lit(cells - 1))
    outside = F.when(value == float("-inf"), -1).otherwise(cells)
    cell = F.when(_finite(value), inside).otherwise(outside).cast("int")
    return rows.join(spans, group).withColumn(name, cell).drop("low", "high")


def _ranks(spans: DataFrame, probabilities: Mapping[str, float]) -> DataFrame:
    """The two ranks next to each probability, counted from 0; no rows come ``before`` a measure."""
    ranks = []
    for prob, p in enumerate(probabilities.values()):
        position = (F.col("total") - 1) * F.lit(float(p))
        for edge, rank in (("low", F.floor(position)), ("high", F.ceil(position))):
            ranks.append(
                F.struct(F.lit(prob).alias("prob"), F.lit(edge).alias("edge"), rank.alias("rank"))
            )
    return spans.select(
        "measure", "total", "mean", F.lit(0).cast("bigint").alias("before"), F.inline(F.array(*ranks))
    )


def _hits(counts: DataFrame, targets: DataFrame, group: list[str], order: str) -> DataFrame:
    """Targets with the row of ``counts`` that holds their rank; running totals are taken once for
    each group, not for each target, and all targets of a group have the same rows before it."""
    totals = Window.partitionBy(*group).orderBy(order)
    running = counts.withColumn("end", F.sum("n").over(totals))
    found = running.join(F.broadcast(targets), group).withColumn("end", F.col("before") + F.col("end"))
    return found.where(_holds_rank())


def _narrowed(rows: DataFrame, targets: DataFrame, group: list[str], name: str) -> DataFrame:
    """Targets with the cell that holds their rank, and the rows before that cell."""
    counts = rows.groupBy(*group, name).agg(F.sum("n").alias("n"))
    hit = _hits(counts, targets, group, name).withColumn("before", F.col("end") - F.col("n"))
    return hit.drop("n", "end")


def _mass(value: Column, n: Column) -> Column:
    """Sum of values, each ``n`` times, in whole millionths, whatever the order; as a double where
    a value is no such number."""
    millionths = F.round(value * 1e6).try_cast("bigint").cast("decimal(20,0)")
    exact = F.sum(millionths * n).cast("double") / 1e6
    return F.when(F.count(value) == F.count(millionths), exact).otherwise(F.sum(value * n))


def _holds_rank() -> Column:
    """``end`` is the number of rows up to and including this one."""
    rank = F.col("rank")
    return (F.col("end") - F.col("n") <= rank) & (rank < F.col("end"))
