"""Sort keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def rank_in(value: Column, order: Sequence[str]) -> Column:
    """1-based position of ``value`` in ``order``; anything else (and NULL) comes after."""
    rank = F.lit(len(order) + 1)
    for position in range(len(order), 0, -1):
        rank = F.when(value == order[position - 1], position).otherwise(rank)
    return rank
