"""Business rules of the raw data, as column expressions and checks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchpost.functions.clock import seconds_elapsed
from watchpost.functions.numeric import round_exact

Tables = Mapping[str, DataFrame]

# Confidence from which a known target is resolved without an operator,
# and the hours of the night shift.
AUTO_RESOLVE_CONFIDENCE = 0.85
UNKNOWN_TARGET = "unknown"
NIGHT_SHIFT_FROM, NIGHT_SHIFT_UNTIL = 22, 6


def is_auto_resolved(confidence: Column, target_class: Column) -> Column:
    return (confidence >= AUTO_RESOLVE_CONFIDENCE) & (target_class != UNKNOWN_TARGET)


def is_overnight(moment: Column) -> Column:
    """22:00-05:59.  Not the same as ``time_of_day = 'night'`` (21:00-04:59)."""
    hour = F.hour(moment)
    return (hour >= NIGHT_SHIFT_FROM) | (hour < NIGHT_SHIFT_UNTIL)


def rule_auto_resolve(tables: Tables) -> DataFrame:
    """Every detection with the outcome the rule gives it."""
    resolved = is_auto_resolved(F.col("confidence_score"), F.col("target_class"))
    return tables["stg_detections"].select(
        "detection_id",
        "target_class",
        "confidence_score",
        resolved.alias("auto_resolved"),
        (~resolved).alias("escalated_to_operator"),
    )


def rule_overnight(tables: Tables) -> DataFrame:
    """Every alert with the night-shift flag the rule gives it."""
    return tables["stg_alert_pipeline"].select(
        "detection_id", "detection_ts", is_overnight(F.col("detection_ts")).alias("is_overnight")
    )


def escalation_queue(tables: Tables) -> DataFrame:
    """Detections that must have a row in the alert pipeline."""
    return tables["stg_detections"].where("escalated_to_operator").select(
        "detection_id", "tower_id", "detected_at", "target_class", "confidence_score"
    )


def escalation_gaps(tables: Tables) -> DataFrame:
    """Where queue and alert pipeline disagree: ``detection_id``, ``problem``."""
    queue = escalation_queue(tables).select("detection_id", F.lit(True).alias("queued"))
    alerts = tables["stg_alert_pipeline"].select("detection_id", F.lit(True).alias("alerted"))
    problem = F.when(F.col("alerted").isNull(), "no alert").when(F.col("queued").isNull(), "not escalated")
    both = queue.join(alerts, "detection_id", "full").select("detection_id", problem.alias("problem"))
    return both.where("problem is not null")


def stage_latencies(tables: Tables) -> DataFrame:
    """The five durations recomputed from the stage timestamps, to 0.1 s."""

    stamps = ["detection_ts", "alert_generated_ts", "operator_notified_ts", "operator_ack_ts", "resolved_ts"]
    spans = {
        "detection_to_alert_s": (stamps[0], stamps[1]),
        "alert_to_notify_s": (stamps[1], stamps[2]),
        "notify_to_ack_s": (stamps[2], stamps[3]),
        "ack_to_resolve_s": (stamps[3], stamps[4]),
        "total_response_s": (stamps[0], stamps[4]),
    }
    exact = tables["stg_alert_pipeline"].select(
        "detection_id",
        *[seconds_elapsed(F.col(start), F.col(end)).alias(name) for name, (start, end) in spans.items()],
    )
    return exact.select("detection_id", *[round_exact(F.col(name), 1).alias(name) for name in spans])


def latest_deployment_per_tower(tables: Tables) -> DataFrame:
    """Last deployment of each active tower; of equal starts the higher id.

    An aggregate, not a window: map-side ``max`` leaves one row per tower and task
    before the shuffle, so a tower with a huge history is no hot spot.
    """
    # Distinct and joined, not a semi join: that would be moved below the aggregate, where
    # it meets every deployment instead of one per tower.
    active = tables["stg_towers"].where(F.col("status") == "active").select("tower_id").distinct()
    history = tables["stg_deployments"]
    newest = F.max(
        F.struct("start_ts", "deployment_id", "mission_name", "end_ts", "status")
    ).alias("newest")
    latest = history.groupBy("tower_id").agg(newest).join(active, "tower_id")
    return latest.select(
        "tower_id",
        "newest.deployment_id",
        "newest.mission_name",
        "newest.start_ts",
        "newest.end_ts",
        "newest.status",
    )
