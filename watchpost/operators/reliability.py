"""Reliability: time between failures, uptime, incident patterns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchpost.functions.clock import AsOf
from watchpost.functions.numeric import exact_mean, round_half_even
from watchpost.operators.scope import facts_at, known_towers

Tables = Mapping[str, DataFrame]

# Names of the series in the long forms.
MTBF_SERIES = {
    "target_hours": "Target",
    "actual_hours_when_failed": "Observed at failure",
}
UPTIME_SERIES = {
    "uptime_pct": "Comms uptime %",
    "sensor_health": "Sensor health score",
}


def mtbf_by_subsystem(tables: Tables, *, site_id: str | None = None) -> DataFrame:
    """Per component type: target, hours reached by failed units, failure rate."""
    components = facts_at(tables, "fct_component_reliability", site_id)
    grouped = components.groupBy("component_type").agg(
        F.avg("mtbf_target_hours").alias("target_hours"),
        F.avg(F.when(F.col("is_failed"), F.col("observed_hours"))).alias("actual_hours_when_failed"),
        F.count(F.lit(1)).alias("installed"),
        F.count_if("is_failed").alias("failed"),
    )
    rate = round_half_even(F.col("failed") / F.col("installed") * 100, 1)
    return grouped.withColumn("failure_rate_pct", rate).orderBy(F.asc_nulls_last("component_type"))


def mtbf_long(tables: Tables, *, site_id: str | None = None) -> DataFrame:
    """Target and observed hours as two labelled rows per component type."""
    wide = mtbf_by_subsystem(tables, site_id=site_id)
    return _labelled(wide, "component_type", MTBF_SERIES, "hours")


def uptime_trend(
    tables: Tables, as_of: AsOf | None = None, *, site_id: str | None = None, days: int | None = None
) -> DataFrame:
    """Fleet means per day, over all days or, with ``days`` and ``as_of``, the last ones."""
    health = facts_at(tables, "fct_fleet_health_daily", site_id)
    if days is not None:
        health = health.where(F.col("health_date") >= as_of.date_days_ago(days))
    return (
        health.groupBy("health_date")
        .agg(
            exact_mean(F.col("comms_uptime_pct")).alias("uptime_pct"),
            exact_mean(F.col("avg_sensor_health")).alias("sensor_health"),
        )
        .orderBy(F.asc_nulls_last("health_date"))
    )


def uptime_long(
    tables: Tables, as_of: AsOf | None = None, *, site_id: str | None = None, days: int | None = None
) -> DataFrame:
    """Uptime and sensor health as two labelled rows per day."""
    wide = uptime_trend(tables, as_of, site_id=site_id, days=days)
    return _labelled(wide, "health_date", UPTIME_SERIES, "value")


def incidents_by_category(tables: Tables, as_of: AsOf, *, site_id: str | None = None) -> DataFrame:
    """Incidents of known towers in the last 30 days per category and severity."""
    recent = tables["stg_incidents"].where(F.col("opened_at") >= as_of.days_ago(30))
    return _count_incidents(recent, tables, site_id, "category", "severity").orderBy(
        F.desc("incidents"), F.asc_nulls_last("category"), F.asc_nulls_last("severity")
    )


def top_root_causes(tables: Tables, *, site_id: str | None = None, length: int = 10) -> DataFrame:
    """The ``length`` most frequent pairs of root cause and category."""
    return (
        _count_incidents(tables["stg_incidents"], tables, site_id, "root_cause", "category")
        .orderBy(F.desc("incidents"), F.asc_nulls_last("root_cause"), F.asc_nulls_last("category"))
        .limit(length)
    )


def _count_incidents(incidents: DataFrame, tables: Tables, site_id: str | None, *by: str) -> DataFrame:
    """Counted per tower before the join, so that its input is one row per tower and group."""
    per_tower = incidents.groupBy("tower_id", *by).agg(F.count(F.lit(1)).alias("n"))
    known = per_tower.join(known_towers(tables, site_id), "tower_id")
    return known.groupBy(*by).agg(F.sum("n").alias("incidents"))


def _labelled(wide: DataFrame, key: str, series: Mapping[str, str], value: str) -> DataFrame:
    labels = F.create_map(*[F.lit(text) for pair in series.items() for text in pair])
    long = wide.unpivot(key, list(series), "metric", value)
    return long.select(key, labels[F.col("metric")].alias("metric"), value)
