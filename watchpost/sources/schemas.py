"""Pinned schemas of the nine staging tables."""

from __future__ import annotations

from pyspark.sql.types import StructType

# Column names and types of the staging layer, in column order.
STAGING_COLUMNS = {
    "sites": {
        "site_id": "string",
        "site_name": "string",
        "region": "string",
        "env": "string",
        "lat": "double",
        "lng": "double",
        "commissioned_date": "date",
    },
    "towers": {
        "tower_id": "string",
        "model": "string",
        "firmware_version": "string",
        "site_id": "string",
        "deploy_date": "date",
        "status": "string",
    },
    "telemetry": {
        "tower_id": "string",
        "ts": "timestamp_ntz",
        "cpu_pct": "double",
        "mem_pct": "double",
        "sensor_health_score": "double",
        "comms_uptime_min": "double",
        "power_watts": "double",
        "ambient_temp_c": "double",
    },
    "deployments": {
        "deployment_id": "string",
        "tower_id": "string",
        "mission_name": "string",
        "start_ts": "timestamp_ntz",
        "end_ts": "timestamp_ntz",
        "status": "string",
    },
    "incidents": {
        "incident_id": "string",
        "tower_id": "string",
        "opened_at": "timestamp_ntz",
        "closed_at": "timestamp_ntz",
        "severity": "string",
        "category": "string",
        "root_cause": "string",
    },
    "components": {
        "component_id": "string",
        "tower_id": "string",
        "component_type": "string",
        "part_number": "string",
        "installed_at": "timestamp_ntz",
        "failed_at": "timestamp_ntz",
        "mtbf_target_hours": "long",
        "is_failed": "boolean",
    },
    "inventory": {
        "part_number": "string",
        "description": "string",
        "category": "string",
        "on_hand": "long",
        "in_transit": "long",
        "allocated": "long",
        "reorder_point": "long",
        "lead_time_days": "long",
        "last_updated": "timestamp_ntz",
    },
    "detections": {
        "detection_id": "string",
        "tower_id": "string",
        "site_id": "string",
        "detected_at": "timestamp_ntz",
        "target_class": "string",
        "confidence_score": "double",
        "bearing_deg": "double",
        "range_m": "integer",
        "auto_resolved": "boolean",
        "escalated_to_operator": "boolean",
        "false_positive": "boolean",
    },
    "alert_pipeline": {
        "detection_id": "string",
        "detection_ts": "timestamp_ntz",
        "alert_generated_ts": "timestamp_ntz",
        "operator_notified_ts": "timestamp_ntz",
        "operator_ack_ts": "timestamp_ntz",
        "resolved_ts": "timestamp_ntz",
        "is_overnight": "boolean",
        "detection_to_alert_s": "double",
        "alert_to_notify_s": "double",
        "notify_to_ack_s": "double",
        "ack_to_resolve_s": "double",
        "total_response_s": "double",
    },
}

RAW_TABLES = tuple(STAGING_COLUMNS)


def staging_schema(name: str) -> StructType:
    schema = StructType()
    for column, type_name in STAGING_COLUMNS[name].items():
        schema.add(column, type_name)
    return schema
