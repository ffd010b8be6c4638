"""Every registered query against its SQL, at the smallest scale."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from harness.compare import difference, open_tables
from harness.oracle import ORACLE_SQL
from harness.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return open_tables(SF_DIR)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_statement(spark, connection, name):
    assert difference(spark, connection, name, SF_DIR) is None


@pytest.mark.parametrize("name", ["fct_fleet_health_daily", "latency_by_stage", "top_root_causes", "dq_unique"])
def test_result_does_not_depend_on_partitioning(spark, connection, name):
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert difference(spark, connection, name, SF_DIR) is None
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_replaced_file_is_seen(spark, tmp_path):
    """The same path with other rows gives other numbers: nothing is kept between calls."""
    for path in Path(SF_DIR).glob("*.parquet"):
        (tmp_path / path.name).symlink_to(path)
    before = QUERIES["kpi_active_towers"](spark, str(tmp_path)).first()[0]
    towers = spark.read.parquet(f"{SF_DIR}/supplier.parquet")
    (tmp_path / "supplier.parquet").unlink()
    towers.union(towers.withColumn("s_suppkey", F.col("s_suppkey") + 1000)).write.parquet(
        str(tmp_path / "supplier.parquet")
    )
    spark.catalog.refreshByPath(str(tmp_path))
    assert QUERIES["kpi_active_towers"](spark, str(tmp_path)).first()[0] > before


@pytest.mark.parametrize("partitions", ["1", "64"])
@pytest.mark.parametrize(
    "name", ["fct_fleet_health_daily", "kpi_uptime", "uptime_trend", "det_kpi", "latency_by_stage", "run_log_summary"]
)
def test_rounded_means_are_the_same_in_any_order(spark, name, partitions):
    """At a scale where means that depend on the order of summation differ."""
    folder = "/root/testdata/sf0.1"
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k" if partitions == "64" else "128m")
    try:
        assert difference(spark, open_tables(folder), name, folder) is None
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(QUERIES) <= set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
