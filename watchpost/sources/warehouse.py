"""Materialized tables: written once, so that queries never go back to raw files."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from watchpost.sources.lazy import LazyTables

# Facts that queries cut by date; the others are read whole or by key.
PARTITIONED_BY = {
    "fct_fleet_health_daily": "health_date",
    "fct_detection_events": "detection_date",
    "fct_alert_pipeline_latency": "detection_date",
}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return configured


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique path below the shared folder."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def write_table(
    df: DataFrame, path: str, *, partition_by: str | None = None, only_given: bool = False
) -> None:
    """Overwrite the table at ``path``, or with ``only_given`` the partitions present in ``df``.

    A partitioned table is rebalanced by its partition column first: one or few files
    per date instead of one per task and date, and AQE cuts a date that is too large for
    one task into several.  The session's overwrite mode has no say.
    """
    if partition_by is None:
        df.write.mode("overwrite").parquet(path)
        return
    rebalanced = df.hint("rebalance", F.col(partition_by))
    mode = "dynamic" if only_given else "static"
    writer = rebalanced.write.mode("overwrite").option("partitionOverwriteMode", mode)
    writer.partitionBy(partition_by).parquet(path)


def materialize(tables: Mapping[str, DataFrame], root: str, names: Iterable[str]) -> None:
    for name in names:
        write_table(tables[name], f"{root}/{name}", partition_by=PARTITIONED_BY.get(name))


def read_tables(spark: SparkSession, root: str, schemas: Mapping[str, StructType]) -> LazyTables:
    """Written tables with their known schemas: no inference, same column order."""
    return LazyTables(
        {name: partial(_read, spark, f"{root}/{name}", schema) for name, schema in schemas.items()}
    )


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make every table a temporary view of its name, for ad-hoc ``spark.sql``."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
