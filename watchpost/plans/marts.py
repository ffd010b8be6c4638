"""Star schema: two dimensions and six facts.

Facts meet the tower dimension in a left join on its unique key.  No broadcast is
forced: Spark broadcasts the dimension while it is below the session's threshold and
otherwise sorts and merges, where AQE splits the partition of a hot tower.  Aggregates
are taken before the join, so that only one row per group travels.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchpost.functions.clock import AsOf, days_between, hours_between
from watchpost.functions.numeric import exact_mean, ieee_divide, round_half_away

Tables = Mapping[str, DataFrame]

# Columns of the telemetry whose daily mean is kept.
MEASURED = (
    "cpu_pct",
    "mem_pct",
    "sensor_health_score",
    "comms_uptime_min",
    "power_watts",
    "ambient_temp_c",
)


def _with_tower(facts: DataFrame, tables: Tables, **columns: str) -> DataFrame:
    """Left join with dim_tower; ``columns`` maps new names to dimension columns."""
    dimension = tables["dim_tower"].select(
        "tower_id", *[F.col(source).alias(name) for name, source in columns.items()]
    )
    return facts.join(dimension, "tower_id", "left")


def dim_site(tables: Tables, as_of: AsOf) -> DataFrame:
    """Sites with tower counts; a decommissioned tower counts in ``tower_count`` only."""
    status = F.col("status")
    counts = (
        tables["stg_towers"]
        .groupBy("site_id")
        .agg(
            F.count(F.lit(1)).alias("tower_count"),
            F.count_if(status == "active").alias("active_tower_count"),
            F.count_if(status == "maintenance").alias("maintenance_tower_count"),
        )
    )
    counted = ["tower_count", "active_tower_count", "maintenance_tower_count"]
    return tables["stg_sites"].join(counts, "site_id", "left").fillna(0, subset=counted)


def dim_tower(tables: Tables, as_of: AsOf) -> DataFrame:
    """Towers with their site and age; an unknown site gives NULL site columns."""
    sites = tables["stg_sites"].select(
        F.col("site_id").alias("known_site"), "site_name", "region", "env"
    )
    towers = tables["stg_towers"]
    return towers.join(sites, towers["site_id"] == sites["known_site"], "left").select(
        "tower_id",
        "model",
        "firmware_version",
        "status",
        "deploy_date",
        days_between(F.col("deploy_date"), as_of.today()).alias("age_days"),
        F.col("known_site").alias("site_id"),
        "site_name",
        "region",
        "env",
    )


def _daily_health(tables: Tables, as_of: AsOf) -> DataFrame:
    """Tower x day.  Incidents on a day without telemetry do not appear."""

    def mean(column: str) -> Column:
        return round_half_away(F.col(f"{column}_mean"), 2)

    day = ["tower_id", "health_date"]
    health = (
        tables["stg_telemetry"]
        .withColumn("health_date", F.to_date("ts"))
        .groupBy(*day)
        .agg(
            *[exact_mean(F.col(column)).alias(f"{column}_mean") for column in MEASURED],
            F.max("ts").alias("last_heartbeat_ts"),
        )
        .select(
            *day,
            mean("cpu_pct").alias("avg_cpu_pct"),
            mean("mem_pct").alias("avg_mem_pct"),
            mean("sensor_health_score").alias("avg_sensor_health"),
            round_half_away(F.col("comms_uptime_min_mean") / 60.0 * 100, 2).alias("comms_uptime_pct"),
            mean("power_watts").alias("avg_power_watts"),
            mean("ambient_temp_c").alias("avg_ambient_temp_c"),
            "last_heartbeat_ts",
        )
    )
    incidents = (
        tables["stg_incidents"]
        .withColumn("health_date", F.to_date("opened_at"))
        .groupBy(*day)
        .agg(
            F.count(F.lit(1)).alias("incidents_opened"),
            F.count_if(F.col("severity").isin("P1", "P2")).alias("critical_incidents"),
        )
    )
    # Both sides are already hashed on (tower, day), so this join needs no shuffle.
    return health.join(incidents, day, "left").fillna(0, ["incidents_opened", "critical_incidents"])


def fct_fleet_health_daily(tables: Tables, as_of: AsOf) -> DataFrame:
    """Tower x day with the tower's site."""
    return health_at_towers(_daily_health(tables, as_of), tables)


def health_at_towers(daily: DataFrame, tables: Tables) -> DataFrame:
    """Daily health, wherever it comes from, in the columns of the fact."""
    return _with_tower(
        daily, tables, site_id="site_id", site_name="site_name", region="region", model="model"
    ).select(
        "tower_id",
        "site_id",
        "site_name",
        "region",
        "model",
        "health_date",
        "avg_cpu_pct",
        "avg_mem_pct",
        "avg_sensor_health",
        "comms_uptime_pct",
        "avg_power_watts",
        "avg_ambient_temp_c",
        "last_heartbeat_ts",
        "incidents_opened",
        "critical_incidents",
    )


def _deployment_durations(tables: Tables, as_of: AsOf) -> DataFrame:
    start, end = F.col("start_ts"), F.coalesce(F.col("end_ts"), as_of.now())
    return tables["stg_deployments"].withColumns(
        {"duration_hours": hours_between(start, end), "duration_days": days_between(start, end)}
    )


def fct_deployment_status(tables: Tables, as_of: AsOf) -> DataFrame:
    """Deployments with their duration so far: to the end, or to now while end is NULL."""
    return _with_tower(
        _deployment_durations(tables, as_of),
        tables,
        site_id="site_id",
        site_name="site_name",
        region="region",
        model="model",
    ).select(
        "deployment_id",
        "tower_id",
        "site_id",
        "site_name",
        "region",
        "model",
        "mission_name",
        "start_ts",
        "end_ts",
        "status",
        "duration_hours",
        "duration_days",
    )


def _component_ages(tables: Tables, as_of: AsOf) -> DataFrame:
    failed_at = F.col("failed_at")
    hours = hours_between(F.col("installed_at"), F.coalesce(failed_at, as_of.now()))
    ratio = F.when(failed_at.isNotNull(), ieee_divide(F.col("observed_hours"), F.col("mtbf_target_hours")))
    # One projection per step: the ratio uses the hours, and the rounding the ratio, often.
    measured = tables["stg_components"].withColumn("observed_hours", hours).withColumn("ratio", ratio)
    return measured.withColumn("actual_vs_target_ratio", round_half_away(F.col("ratio"), 3)).drop("ratio")


def fct_component_reliability(tables: Tables, as_of: AsOf) -> DataFrame:
    """Components with hours observed, to failure or to now, against the target."""
    return _with_tower(
        _component_ages(tables, as_of),
        tables,
        site_id="site_id",
        site_name="site_name",
        region="region",
        tower_model="model",
    ).select(
        "component_id",
        "tower_id",
        "site_id",
        "site_name",
        "region",
        "tower_model",
        "component_type",
        "part_number",
        "installed_at",
        "failed_at",
        "is_failed",
        "mtbf_target_hours",
        "observed_hours",
        "actual_vs_target_ratio",
    )


def fct_inventory_status(tables: Tables, as_of: AsOf) -> DataFrame:
    """Parts with available stock on a four-level scale; unknown stock counts as healthy."""
    available, reorder_point = F.col("available"), F.col("reorder_point")
    below = F.coalesce(available < reorder_point, F.lit(False))
    level = (
        F.when(available <= 0, "critical")
        .when(available < reorder_point, "reorder")
        .when(available < reorder_point * 1.5, "watch")
        .otherwise("healthy")
    )
    return (
        tables["stg_inventory"]
        .withColumn("available", F.col("on_hand") - F.col("allocated"))
        .select(
            "part_number",
            "description",
            "category",
            "on_hand",
            "in_transit",
            "allocated",
            "available",
            "reorder_point",
            below.alias("needs_reorder"),
            level.alias("stock_status"),
            "lead_time_days",
            "last_updated",
        )
    )


def _detection_events(tables: Tables, as_of: AsOf) -> DataFrame:
    hour = F.hour("detected_at")
    part_of_day = (
        F.when(hour.between(5, 7), "dawn")
        .when(hour.between(8, 17), "day")
        .when(hour.between(18, 20), "dusk")
        .otherwise("night")
    )
    return tables["stg_detections"].drop("site_id").withColumns(
        {
            "detection_date": F.to_date("detected_at"),
            "hour_of_day": hour.cast("bigint"),
            "time_of_day": part_of_day,
        }
    )


def fct_detection_events(tables: Tables, as_of: AsOf) -> DataFrame:
    """Detections with calendar parts.  The site is the tower's, not the detection's own."""
    return _with_tower(
        _detection_events(tables, as_of),
        tables,
        site_id="site_id",
        site_name="site_name",
        region="region",
        tower_model="model",
    ).select(
        "detection_id",
        "tower_id",
        "site_id",
        "site_name",
        "region",
        "tower_model",
        "detected_at",
        "detection_date",
        "hour_of_day",
        "time_of_day",
        "target_class",
        "confidence_score",
        "bearing_deg",
        "range_m",
        "auto_resolved",
        "escalated_to_operator",
        "false_positive",
    )


def _alert_stages(tables: Tables, as_of: AsOf) -> DataFrame:
    detections = tables["stg_detections"].select(
        "detection_id", "tower_id", "target_class", "confidence_score"
    )
    alerts = tables["stg_alert_pipeline"].join(detections, "detection_id")
    return alerts.withColumn("detection_date", F.to_date("detection_ts"))


def fct_alert_pipeline_latency(tables: Tables, as_of: AsOf) -> DataFrame:
    """Escalated detections with stage times; alerts without a detection are dropped."""
    alerts = _alert_stages(tables, as_of)
    return _with_tower(alerts, tables, site_id="site_id", site_name="site_name").select(
        "detection_id",
        "tower_id",
        "site_id",
        "site_name",
        "target_class",
        "confidence_score",
        "detection_ts",
        "detection_date",
        "is_overnight",
        "detection_to_alert_s",
        "alert_to_notify_s",
        "notify_to_ack_s",
        "ack_to_resolve_s",
        "total_response_s",
        "alert_generated_ts",
        "operator_notified_ts",
        "operator_ack_ts",
        "resolved_ts",
    )


MARTS: dict[str, Callable[[Tables, AsOf], DataFrame]] = {
    model.__name__: model
    for model in (
        dim_site,
        dim_tower,
        fct_fleet_health_daily,
        fct_deployment_status,
        fct_component_reliability,
        fct_inventory_status,
        fct_detection_events,
        fct_alert_pipeline_latency,
    )
}

# What each mart is built from.
INPUTS: dict[str, tuple[str, ...]] = {
    "dim_site": ("stg_sites", "stg_towers"),
    "dim_tower": ("stg_sites", "stg_towers"),
    "fct_fleet_health_daily": ("stg_telemetry", "stg_incidents", "dim_tower"),
    "fct_deployment_status": ("stg_deployments", "dim_tower"),
    "fct_component_reliability": ("stg_components", "dim_tower"),
    "fct_inventory_status": ("stg_inventory",),
    "fct_detection_events": ("stg_detections", "dim_tower"),
    "fct_alert_pipeline_latency": ("stg_alert_pipeline", "stg_detections", "dim_tower"),
}

# The facts before they meet the tower dimension, for queries that use none of its columns.
WITHOUT_TOWER: dict[str, Callable[[Tables, AsOf], DataFrame]] = {
    "fct_fleet_health_daily": _daily_health,
    "fct_deployment_status": _deployment_durations,
    "fct_component_reliability": _component_ages,
    "fct_detection_events": _detection_events,
    "fct_alert_pipeline_latency": _alert_stages,
}
