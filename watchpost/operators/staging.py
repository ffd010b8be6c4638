"""Staging tables: column selection and strict casts, nothing else.

Casts raise on bad values (ANSI mode); they are not ``try_cast`` on purpose.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql.types import DateType, LongType, TimestampNTZType

from watchpost.sources.schemas import RAW_TABLES, staging_schema


def stage(name: str, raw: DataFrame) -> DataFrame:
    """Raw table ``name`` with its pinned columns and types.  Also works on a stream."""
    columns = []
    for field in staging_schema(name):
        value = f"`{field.name}`"
        temporal = isinstance(field.dataType, (TimestampNTZType, DateType))
        if temporal and isinstance(raw.schema[field.name].dataType, LongType):
            value = _from_nanoseconds(value)
        columns.append(f"cast({value} as {field.dataType.simpleString()}) as `{field.name}`")
    return raw.selectExpr(*columns)


def _from_nanoseconds(value: str) -> str:
    microseconds = f"({value} - pmod({value}, 1000)) div 1000"
    return f"timestampadd(MICROSECOND, {microseconds}, timestamp_ntz'1970-01-01 00:00:00')"


def _staging_model(name: str) -> Callable[[Mapping[str, DataFrame]], DataFrame]:
    return lambda raw: stage(name, raw[name])


# stg_sites ... stg_alert_pipeline: function of the raw tables.
STAGING_MODELS = {f"stg_{name}": _staging_model(name) for name in RAW_TABLES}
