"""Declared data-quality checks of the staging tables and marts."""

from __future__ import annotations

from dataclasses import dataclass

# What is declared about each model.

# Key columns: unique and not null.
KEYS = {
    "stg_sites": "site_id",
    "stg_towers": "tower_id",
    "stg_deployments": "deployment_id",
    "stg_incidents": "incident_id",
    "stg_components": "component_id",
    "stg_inventory": "part_number",
    "stg_detections": "detection_id",
    "stg_alert_pipeline": "detection_id",
    "dim_site": "site_id",
    "dim_tower": "tower_id",
    "fct_deployment_status": "deployment_id",
    "fct_component_reliability": "component_id",
    "fct_inventory_status": "part_number",
    "fct_detection_events": "detection_id",
    "fct_alert_pipeline_latency": "detection_id",
}

# Further columns that must not be null.
REQUIRED = {
    "stg_towers": ("site_id",),
    "stg_telemetry": ("tower_id",),
    "stg_deployments": ("tower_id",),
    "stg_detections": ("tower_id", "confidence_score", "target_class"),
    "fct_fleet_health_daily": ("tower_id", "health_date", "comms_uptime_pct"),
    "fct_component_reliability": ("component_type",),
    "fct_detection_events": ("tower_id", "target_class"),
    "fct_alert_pipeline_latency": ("total_response_s",),
}

# Enumerations.
TARGET_CLASSES = ("human", "vehicle", "UAS", "unknown")
ACCEPTED = {
    ("stg_sites", "env"): ("coastal", "desert", "plains", "forest", "tundra"),
    ("stg_towers", "status"): ("active", "maintenance", "decommissioned"),
    ("stg_incidents", "severity"): ("P1", "P2", "P3", "P4"),
    ("stg_components", "component_type"): ("radar", "eo_ir", "comm", "power", "compute"),
    ("stg_detections", "target_class"): TARGET_CLASSES,
    ("fct_deployment_status", "status"): ("active", "completed"),
    ("fct_inventory_status", "stock_status"): ("critical", "reorder", "watch", "healthy"),
    ("fct_detection_events", "target_class"): TARGET_CLASSES,
    ("fct_detection_events", "time_of_day"): ("dawn", "day", "dusk", "night"),
}

# Foreign keys: child column -> parent model and column.
REFERENCES = {
    ("stg_towers", "site_id"): ("stg_sites", "site_id"),
    ("stg_telemetry", "tower_id"): ("stg_towers", "tower_id"),
    ("stg_deployments", "tower_id"): ("stg_towers", "tower_id"),
    ("stg_detections", "tower_id"): ("stg_towers", "tower_id"),
    ("dim_tower", "site_id"): ("dim_site", "site_id"),
}

NOT_NULL, UNIQUE, ACCEPTED_VALUES, RELATIONSHIPS = (
    "not_null",
    "unique",
    "accepted_values",
    "relationships",
)


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    test: str
    values: tuple[str, ...] = ()
    parent: tuple[str, str] | None = None


def declared_checks() -> list[Check]:
    checks = [Check(model, column, UNIQUE) for model, column in KEYS.items()]
    checks += [Check(model, column, NOT_NULL) for model, column in KEYS.items()]
    checks += [Check(model, c, NOT_NULL) for model, columns in REQUIRED.items() for c in columns]
    checks += [Check(m, c, ACCEPTED_VALUES, values=values) for (m, c), values in ACCEPTED.items()]
    checks += [Check(m, c, RELATIONSHIPS, parent=parent) for (m, c), parent in REFERENCES.items()]
    return checks
