"""Header metrics.  Every function returns exactly one row (except the selector).

A count over nothing is 0, a mean or maximum over nothing is NULL.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchpost.functions.clock import AsOf
from watchpost.functions.numeric import exact_mean
from watchpost.operators.scope import at_site, facts_at, sum_by_tower

Tables = Mapping[str, DataFrame]

# A change smaller than this is not worth showing.
NEGLIGIBLE = 0.05


def site_options(tables: Tables) -> DataFrame:
    """Sites for the selector, by name, with the text shown; counts of towers aren't needed."""
    label = F.concat_ws("  ·  ", "site_name", "site_id")
    return (
        tables["stg_sites" if "stg_sites" in tables else "dim_site"]
        .select("site_id", "site_name", "region", label.alias("label"))
        .orderBy(F.asc_nulls_last("site_name"), "site_id")
    )


def last_telemetry(tables: Tables) -> DataFrame:
    return tables["stg_telemetry"].agg(F.max("ts").alias("last_telemetry_ts"))


def active_towers(tables: Tables, *, site_id: str | None = None) -> DataFrame:
    """Active towers; only with a site does the tower's site have to be a known one."""
    whole = site_id is None and "stg_towers" in tables
    towers = tables["stg_towers"] if whole else at_site(tables["dim_tower"], site_id)
    return towers.agg(F.count_if(F.col("status") == "active").alias("active_towers"))


def active_deployments(tables: Tables, *, site_id: str | None = None) -> DataFrame:
    active = facts_at(tables, "fct_deployment_status", site_id).where(F.col("status") == "active")
    return active.agg(F.count(F.lit(1)).alias("active_deployments"))


def _is_open() -> Column:
    return F.col("closed_at").isNull()


def _is_critical() -> Column:
    return F.col("severity").isin("P1", "P2")


def _was_open(cutoff: Column) -> Column:
    return (F.col("opened_at") <= cutoff) & (_is_open() | (F.col("closed_at") > cutoff))


def open_incidents(tables: Tables, *, site_id: str | None = None) -> DataFrame:
    """Open incidents of known towers, all and P1/P2."""
    counts = {
        "open_incidents": F.count(F.lit(1)),
        "critical_open": F.count_if(_is_critical()),
    }
    return sum_by_tower(tables["stg_incidents"].where(_is_open()), tables, site_id, counts)


def backlog_7d_ago(tables: Tables, as_of: AsOf, *, site_id: str | None = None) -> DataFrame:
    """Incidents that were open seven days before ``as_of``."""
    backlog = tables["stg_incidents"].where(_was_open(as_of.days_ago(7)))
    return sum_by_tower(backlog, tables, site_id, {"inc_open_7d_ago": F.count(F.lit(1))})


def uptime(tables: Tables, as_of: AsOf, *, site_id: str | None = None) -> DataFrame:
    """Mean tower-day uptime of the last and the previous week.

    The last week starts at the date seven days back and has no end, so it spans eight
    calendar dates when today is already there; the previous one spans seven.
    """
    day, start = F.col("health_date"), as_of.date_days_ago(7)
    recent = facts_at(tables, "fct_fleet_health_daily", site_id).where(day >= as_of.date_days_ago(14))
    return recent.agg(
        exact_mean(F.when(day >= start, F.col("comms_uptime_pct"))).alias("uptime_7d"),
        exact_mean(F.when(day < start, F.col("comms_uptime_pct"))).alias("uptime_prev_7d"),
    )


def failures(tables: Tables, as_of: AsOf, *, site_id: str | None = None) -> DataFrame:
    """Components that failed in the last 30 days and in the 30 days before."""
    failed_at, start = F.col("failed_at"), as_of.days_ago(30)
    failed = facts_at(tables, "fct_component_reliability", site_id).where(
        F.col("is_failed") & (failed_at >= as_of.days_ago(60))
    )
    return failed.agg(
        F.count_if(failed_at >= start).alias("failed_components_30d"),
        F.count_if(failed_at < start).alias("failed_components_prev_30d"),
    )


def change(current: Column, previous: Column) -> Column:
    """Difference, or NULL if either side is missing or the change is negligible."""
    difference = current.cast("double") - previous.cast("double")
    known = ~F.isnan(difference) & (F.abs(difference) >= NEGLIGIBLE)
    return F.when(known, difference)


def kpi_header(tables: Tables, as_of: AsOf, *, site_id: str | None = None) -> DataFrame:
    """All header numbers and three changes in one row; each table is read once."""
    incidents = sum_by_tower(
        tables["stg_incidents"].where(_is_open() | _was_open(as_of.days_ago(7))),
        tables,
        site_id,
        {
            "open_incidents": F.count_if(_is_open()),
            "critical_open": F.count_if(_is_open() & _is_critical()),
            "inc_open_7d_ago": F.count_if(_was_open(as_of.days_ago(7))),
        },
    )
    parts = [
        active_towers(tables, site_id=site_id),
        active_deployments(tables, site_id=site_id),
        incidents,
        uptime(tables, as_of, site_id=site_id),
        failures(tables, as_of, site_id=site_id),
    ]
    # One-row frames stacked and folded into one row: no join between them is needed.
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    numbers = [
        "active_towers",
        "active_deployments",
        "open_incidents",
        "critical_open",
        "uptime_7d",
        "uptime_prev_7d",
        "failed_components_30d",
        "failed_components_prev_30d",
        "inc_open_7d_ago",
    ]
    header = stacked.agg(*[F.max(name).alias(name) for name in numbers])
    return header.select(
        *numbers,
        change(F.col("uptime_7d"), F.col("uptime_prev_7d")).alias("uptime_delta"),
        change(F.col("failed_components_30d"), F.col("failed_components_prev_30d")).alias("failures_delta"),
        change(F.col("open_incidents"), F.col("inc_open_7d_ago")).alias("incidents_delta"),
    )
