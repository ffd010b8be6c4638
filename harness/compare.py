"""Run queries next to their SQL on the same files and compare values and types.

    python -m harness.compare SF_DIR [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

from pyspark.sql import SparkSession

from harness.oracle import ORACLE_SQL
from harness.queries import QUERIES
from watchpost.session import configure


def local_session(cores: str = "8") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("watchpost")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = configure(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def open_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    import duckdb  # only here: sessions work without it

    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return connection


# Spark type -> DuckDB type of the same values.
_TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def difference(spark: SparkSession, connection, name: str, sf_dir: str) -> str | None:
    """None if rows and types agree, else a description of the first disagreement."""
    result = QUERIES[name](spark, sf_dir)
    relation = connection.sql(ORACLE_SQL[name])
    ours = {field.name: _TYPES.get(field.dataType.simpleString()) for field in result.schema}
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    if ours != theirs:
        return f"schema: {sorted(set(ours.items()) ^ set(theirs.items()))}"
    columns = sorted(ours)
    left = Counter(tuple(row[c] for c in columns) for row in result.collect())
    order = [relation.columns.index(c) for c in columns]
    right = Counter(tuple(row[i] for i in order) for row in relation.fetchall())
    if left != right:
        extra, missing = left - right, right - left
        return (
            f"{sum(left.values())} rows against {sum(right.values())}; only in Spark "
            f"{list(extra)[:2]}, only in SQL {list(missing)[:2]}"
        )
    return None


def main(sf_dir: str, names: list[str]) -> int:
    spark, connection = local_session(), open_tables(sf_dir)
    failed = 0
    for name in names or QUERIES:
        started = time.perf_counter()
        try:
            problem = difference(spark, connection, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{time.perf_counter() - started:6.2f}s  {name}: {problem or 'equal'}", flush=True)
    print(f"{failed} of {len(names or QUERIES)} differ")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
