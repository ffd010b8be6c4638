"""Operations: sites, running missions, open incidents, stock to reorder."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchpost.functions.clock import AsOf, hours_between
from watchpost.functions.numeric import round_half_even
from watchpost.functions.ordering import rank_in
from watchpost.operators.scope import at_site, known_towers

Tables = Mapping[str, DataFrame]

# Display order of severities and of stock levels.
SEVERITIES = ("P1", "P2", "P3")
STOCK_LEVELS = ("critical", "reorder", "watch")


def _site_order() -> list:
    return [F.desc_nulls_last("tower_count"), F.asc("site_id")]


def site_status(tables: Tables, *, site_id: str | None = None) -> DataFrame:
    """Sites with tower counts and open incidents, the largest first."""
    return _site_status(tables, site_id).orderBy(*_site_order())


def _site_status(tables: Tables, site_id: str | None) -> DataFrame:
    open_by_tower = (
        tables["stg_incidents"]
        .where(F.col("closed_at").isNull())
        .groupBy("tower_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    open_by_site = (
        open_by_tower.join(known_towers(tables, site_id, "site_id"), "tower_id")
        .groupBy("site_id")
        .agg(F.sum("n").alias("open_incidents"))
    )
    return (
        at_site(tables["dim_site"], site_id)
        .join(open_by_site, "site_id", "left")
        .select(
            "site_name",
            "site_id",
            "region",
            "env",
            "tower_count",
            "active_tower_count",
            "maintenance_tower_count",
            "lat",
            "lng",
            F.coalesce("open_incidents", F.lit(0)).alias("open_incidents"),
        )
    )


def detection_density(tables: Tables, as_of: AsOf) -> DataFrame:
    """Detections per site since the date seven days back; NULL site = unknown tower."""
    recent = F.col("detection_date") >= as_of.date_days_ago(7)
    return (
        tables["fct_detection_events"]
        .where(recent)
        .groupBy("site_id")
        .agg(F.count(F.lit(1)).alias("dets_7d"))
    )


def site_status_density(tables: Tables, as_of: AsOf, *, site_id: str | None = None) -> DataFrame:
    """Site status with detections per active tower.

    Sites without detections or without active towers get 0; so does every site when
    there is no detection table at all.  Detections of towers under maintenance count.
    """
    status = _site_status(tables, site_id)
    if "fct_detection_events" in tables:
        seen = status.join(detection_density(tables, as_of), "site_id", "left")
        per_tower = F.try_divide(F.col("dets_7d"), F.col("active_tower_count"))
    else:
        seen = status.withColumn("dets_7d", F.lit(0).cast("bigint"))
        per_tower = F.lit(0.0)
    return seen.select(
        *status.columns,
        F.coalesce("dets_7d", F.lit(0)).alias("dets_7d"),
        round_half_even(F.coalesce(per_tower, F.lit(0.0)), 1).alias("dets_per_active_tower"),
    ).orderBy(*_site_order())


def active_missions(tables: Tables, *, site_id: str | None = None, length: int = 25) -> DataFrame:
    """Running deployments, the ``length`` newest first."""
    running = at_site(tables["fct_deployment_status"], site_id).where(F.col("status") == "active")
    return (
        running.orderBy(F.desc_nulls_last("start_ts"), "deployment_id")
        .limit(length)
        .select(
            "deployment_id",
            "mission_name",
            "tower_id",
            "site_name",
            F.col("start_ts").alias("deployed"),
            F.col("duration_days").alias("days_on_station"),
        )
    )


def open_incident_list(
    tables: Tables, as_of: AsOf, *, site_id: str | None = None, length: int = 25
) -> DataFrame:
    """Open incidents of known towers, the ``length`` most severe and oldest first."""
    listed = (
        tables["stg_incidents"]
        .where(F.col("closed_at").isNull())
        .join(known_towers(tables, site_id, "site_name"), "tower_id")
        .orderBy(
            rank_in(F.col("severity"), SEVERITIES), F.asc_nulls_last("opened_at"), "incident_id"
        )
        .limit(length)
    )
    return listed.select(
        "incident_id",
        "severity",
        "category",
        "tower_id",
        "site_name",
        "opened_at",
        hours_between(F.col("opened_at"), as_of.now()).alias("age_hours"),
        "root_cause",
    )


def low_inventory(tables: Tables) -> DataFrame:
    """Parts at or near their reorder point, most urgent first."""
    return (
        tables["fct_inventory_status"]
        .where(F.col("stock_status").isin(*STOCK_LEVELS))
        .orderBy(
            rank_in(F.col("stock_status"), STOCK_LEVELS), F.asc_nulls_last("available"), "part_number"
        )
        .select(
            "part_number",
            "description",
            "category",
            "on_hand",
            "allocated",
            "available",
            "reorder_point",
            "stock_status",
            "lead_time_days",
        )
    )
