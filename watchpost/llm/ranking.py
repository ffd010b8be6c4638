"""Row numbers within groups of any size, without a task that has to see a whole group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchpost.llm.storage import checkpointed

_LOCAL_BITS = 33  # of monotonically_increasing_id(): the row's number in its partition
BLOCK_ROWS = 10_000  # that one row is turned into in one place


def same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """Null-safe equality of columns; ``right`` has them with the prefix ``__``."""
    return reduce(Column.__and__, [left[n].eqNullSafe(right[f"__{n}"]) for n in names])


def prefixed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({n: f"__{n}" for n in names})


def numbered_within(rows: DataFrame, group: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with the column ``name``: the row's number within its group, from 0, in this order.

    A range sort spreads large groups over partitions; the counts of the partitions, one number for
    each, make the numbers global, and the smallest of each group is taken off.  Meant for narrow
    rows whose group and order columns tell them apart.
    """
    ordered = rows.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    # Numbers are fixed by the checkpoint: a partition that is computed again may differ.
    at = checkpointed(ordered.withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", _LOCAL_BITS).cast("int")
    counts = sorted(at.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    if not counts:
        return at.select(*rows.columns, F.lit(0).cast("long").alias(name))
    begins = [0, *accumulate(n for _, n in counts)]
    offsets = rows.sparkSession.createDataFrame(
        [(p, begin) for (p, _), begin in zip(counts, begins)], "__part int, __begin long"
    )
    whole = at.join(F.broadcast(offsets), part == F.col("__part")).select(
        *rows.columns, (F.col("__begin") + F.col("__at").bitwiseAND((1 << _LOCAL_BITS) - 1)).alias("__at")
    )
    first = prefixed(whole.groupBy(*group).agg(F.min("__at").alias("__first")), group)
    return whole.join(first, same(whole, first, group)).select(
        *rows.columns, (F.col("__at") - F.col("__first")).alias(name)
    )


def repeated(groups: DataFrame, count: str, number: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Each row ``count`` times, with its ``number`` from 1.

    A row that stands for very many is cut into blocks first, which are dealt out, so that no task
    makes them all.
    """
    n = F.col(count)
    last = F.floor((n - 1) / block_rows)
    blocks = groups.withColumn("__block", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    first = F.col("__block") * block_rows
    numbers = F.sequence(first + 1, F.least(first + block_rows, n))
    return blocks.repartition("__block", *groups.columns).withColumn(number, F.explode(numbers)).drop("__block")
