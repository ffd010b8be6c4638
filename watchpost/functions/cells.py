"""Running sums and last known values over groups of any size.

A window over a whole group puts the group into one task, and a group may hold a third of all
rows.  Here rows are ordered inside *cells*, parts of a group's order such as its days, and what the
cells before have summed or seen comes from one row per cell.  A cell is a fixed span of the order
column, so its rows grow with the density of the data, not with its history; the windows over cells
grow with the history, not with the rows.  Rows are shuffled by group and cell once; what is kept per
cell is combined in the tasks before its own, small shuffle.  The input is read twice, for cells with
the columns they need only, so put wide or costly work after these operators, not before.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _before(names: Sequence[str]) -> list[Column]:
    return [F.col(name).alias(f"__{name}") for name in names]


def _matching(keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])


def running_sums(
    rows: DataFrame,
    group: Sequence[str],
    cell: str,
    order: Sequence[str],
    sums: Mapping[str, Column],
    *,
    totals: Mapping[str, str] | None = None,
) -> DataFrame:
    """``rows`` with, for each new name, the sum of its expression over all rows of the group that
    come earlier; 0 for the first.

    ``cell`` is a column that never falls along ``order``; ``order`` must tell rows apart, or else the
    sums of equal rows are dealt among them in any order.  ``totals`` names columns for the sums over
    the whole group.  Null group values are a group; null addends count as 0.
    """
    keys = [*group, cell]
    summands = {name: F.coalesce(value, F.lit(0)) for name, value in sums.items()}
    added = rows.withColumns({f"__add_{name}": value for name, value in summands.items()})
    per_cell = added.groupBy(*keys).agg(*[F.sum(f"__add_{name}").alias(f"__sum_{name}") for name in sums])
    earlier = Window.partitionBy(*group).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    cells = per_cell.select(
        *_before(keys),
        *[F.coalesce(F.sum(f"__sum_{name}").over(earlier), F.lit(0)).alias(f"__off_{name}") for name in sums],
        *[F.sum(f"__sum_{name}").over(whole).alias(f"__all_{name}") for name in totals or {}],
    )
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = added.withColumns(
        {f"__in_{name}": F.coalesce(F.sum(f"__add_{name}").over(inside), F.lit(0)) for name in sums}
    )
    both = local.join(cells, _matching(keys))
    return both.select(
        *rows.columns,
        *[(F.col(f"__in_{name}") + F.col(f"__off_{name}")).alias(name) for name in sums],
        *[F.col(f"__all_{name}").alias(total) for name, total in (totals or {}).items()],
    )


def last_before(
    rows: DataFrame,
    group: Sequence[str],
    cell: str,
    order: Sequence[str],
    values: Mapping[str, Column],
) -> DataFrame:
    """``rows`` with, for each new name, the last value of its expression that isn't null among the
    rows of the group that come earlier; null where there is none.

    ``cell`` never falls along ``order``.  A value that is a struct is null as a whole or not at all.
    """
    keys = [*group, cell]
    marked = rows.withColumns({f"__val_{name}": value for name, value in values.items()})
    last = {
        name: F.max_by(f"__val_{name}", F.when(F.col(f"__val_{name}").isNotNull(), F.struct(*order))) for name in values
    }
    per_cell = marked.groupBy(*keys).agg(*[last[name].alias(f"__last_{name}") for name in values])
    earlier = Window.partitionBy(*group).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    cells = per_cell.select(
        *_before(keys),
        *[F.last(f"__last_{name}", ignorenulls=True).over(earlier).alias(f"__seen_{name}") for name in values],
    )
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = marked.withColumns(
        {f"__in_{name}": F.last(f"__val_{name}", ignorenulls=True).over(inside) for name in values}
    )
    both = local.join(cells, _matching(keys))
    return both.select(
        *rows.columns,
        *[F.coalesce(F.col(f"__in_{name}"), F.col(f"__seen_{name}")).alias(name) for name in values],
    )
