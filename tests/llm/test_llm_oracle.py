"""Registered queries of the subpackage against their SQL, at the smallest scale."""

from __future__ import annotations

from collections import Counter

import pytest

from harness.compare import open_tables
from watchpost.llm.oracle import ORACLE_SQL
from watchpost.llm.queries import QUERIES


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_query_equals_its_statement(spark, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    cursor = open_tables(sf_dir).execute(ORACLE_SQL[name])
    names = [c[0] for c in cursor.description]
    assert sorted(result.columns) == sorted(names)
    theirs = Counter(tuple(row[names.index(c)] for c in result.columns) for row in cursor.fetchall())
    assert Counter(map(tuple, result.collect())) == theirs


def test_queries_are_registered():
    import __spark_entry__

    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
