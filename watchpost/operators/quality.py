"""Data-quality checks as aggregates.

What counts as a failure: ``not_null`` a row without a value; ``unique`` a value that
occurs more than once; ``accepted_values`` a distinct value outside the list (NULL
passes); ``relationships`` a row whose value has no parent (NULL passes).
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchpost.plans.checks import (
    ACCEPTED_VALUES,
    NOT_NULL,
    RELATIONSHIPS,
    UNIQUE,
    Check,
    declared_checks,
)

Tables = Mapping[str, DataFrame]


def run_checks(tables: Tables, checks: Iterable[Check]) -> DataFrame:
    """``model``, ``column_name``, ``test``, ``failures``, ``status``: one row per check."""
    numbered = list(enumerate(checks))
    by_model: dict[str, list[tuple[int, Check]]] = defaultdict(list)
    found = []
    for number, check in numbered:
        if check.test == UNIQUE:
            found.append(_duplicates(tables[check.model], number, check))
        elif check.test == RELATIONSHIPS:
            found.append(_orphans(tables, number, check))
        else:
            by_model[check.model].append((number, check))
    found += [_bad_rows(tables[model], listed) for model, listed in by_model.items()]

    failures = reduce(DataFrame.unionByName, found)
    listing = ", ".join(
        f"struct({number} as number, {_text(check.model)} as model,"
        f" {_text(check.column)} as column_name, {_text(check.test)} as test)"
        for number, check in numbered
    )
    return (
        failures.sparkSession.range(1)
        .selectExpr(f"inline(array({listing}))")
        .join(failures, "number", "left")
        .selectExpr("model", "column_name", "test", "coalesce(failures, 0L) as failures")
        .selectExpr("*", "if(failures = 0, 'pass', 'fail') as status")
    )


# Conditions are SQL text: one expression per table instead of dozens of column objects.
def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _violated(check: Check) -> str:
    if check.test == NOT_NULL:
        return f"(`{check.column}` is null)"
    # NULL is neither in the list nor outside of it.
    return f"(`{check.column}` not in ({', '.join(map(_text, check.values))}))"


def _bad_rows(df: DataFrame, checks: Sequence[tuple[int, Check]]) -> DataFrame:
    """All not_null and accepted_values checks of one table in one scan.

    The filter comes first: it is pushed to the parquet reader, which skips row groups
    whose statistics show no NULL, and on clean data nothing is left for the shuffle.
    """
    hits = ", ".join(
        f"struct({number} as number, {_violated(check)} as hit, "
        + (f"string(`{check.column}`)" if check.test == ACCEPTED_VALUES else "string(null)")
        + " as value)"
        for number, check in checks
    )
    per_value = (
        df.where(" or ".join(_violated(check) for _, check in checks))
        .selectExpr(f"inline(array({hits}))")
        .where("hit")
        .groupBy("number", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # A NULL value stands for rows of a not_null check, any other for one bad value.
    return per_value.groupBy("number").agg(F.expr("sum(if(value is null, n, 1L)) as failures"))


def _duplicates(df: DataFrame, number: int, check: Check) -> DataFrame:
    repeated = (
        df.where(F.col(check.column).isNotNull())
        .groupBy(check.column)
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    return repeated.agg(F.count(F.lit(1)).alias("failures")).selectExpr(f"{number} as number", "failures")


def _orphans(tables: Tables, number: int, check: Check) -> DataFrame:
    """Counted per value before the anti join: a hot value is one row there."""
    model, column = check.parent
    parents = tables[model].selectExpr(f"`{column}` as value")
    values = (
        tables[check.model]
        .selectExpr(f"`{check.column}` as value")
        .where("value is not null")
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    orphans = values.join(parents, "value", "left_anti")
    return orphans.selectExpr(f"{number} as number", "coalesce(sum(n), 0L) as failures")


def _of_kind(tables: Tables, test: str) -> DataFrame:
    chosen = [check for check in declared_checks() if check.test == test]
    return run_checks(tables, chosen).select("model", "column_name", "failures")


def dq_not_null(tables: Tables) -> DataFrame:
    return _of_kind(tables, NOT_NULL)


def dq_unique(tables: Tables) -> DataFrame:
    return _of_kind(tables, UNIQUE)


def dq_accepted_values(tables: Tables) -> DataFrame:
    return _of_kind(tables, ACCEPTED_VALUES)


def dq_relationships(tables: Tables) -> DataFrame:
    return _of_kind(tables, RELATIONSHIPS)


def dq_suite(tables: Tables) -> DataFrame:
    return run_checks(tables, declared_checks())
