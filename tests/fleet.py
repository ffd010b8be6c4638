"""Small hand-written raw tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from watchpost.plans.star import StarSchema
from watchpost.sources.schemas import RAW_TABLES, staging_schema

AS_OF = "2024-01-31 12:00:00"


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def raw_table(spark: SparkSession, name: str, rows: list[dict]) -> DataFrame:
    """Rows given as dicts; columns left out are NULL."""
    schema = staging_schema(name)
    unknown = {key for row in rows for key in row} - set(schema.fieldNames())
    assert not unknown, unknown
    data = [tuple(row.get(field) for field in schema.fieldNames()) for row in rows]
    return spark.createDataFrame(data, schema)


def fleet(spark: SparkSession, as_of: str = AS_OF, **rows: list[dict]) -> StarSchema:
    raw = {name: raw_table(spark, name, rows.get(name, [])) for name in RAW_TABLES}
    return StarSchema(raw, as_of)


def records(df: DataFrame) -> list[dict]:
    return [row.asDict() for row in df.collect()]


SITES = [
    {"site_id": "S1", "site_name": "Alpha", "region": "West", "env": "coastal"},
    {"site_id": "S2", "site_name": "Bravo", "region": "East", "env": "desert"},
]
TOWERS = [
    {"tower_id": "T1", "site_id": "S1", "status": "active", "model": "V2"},
    {"tower_id": "T2", "site_id": "S1", "status": "maintenance", "model": "V3"},
    {"tower_id": "T3", "site_id": "S2", "status": "decommissioned", "model": "V3"},
    {"tower_id": "T4", "site_id": "S9", "status": "active", "model": "V2"},
]
