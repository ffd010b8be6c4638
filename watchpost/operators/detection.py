"""Detections: volume, outcome shares, response latency."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchpost.functions.clock import AsOf
from watchpost.functions.numeric import percent_mean, percent_true, round_half_away
from watchpost.functions.quantiles import percentiles
from watchpost.operators.scope import facts_at, known_towers

Tables = Mapping[str, DataFrame]

# The reported percentiles, and the stages in order with their columns.
PERCENTILES = {"p50": 0.50, "p95": 0.95, "p99": 0.99}
STAGES = {
    "Detection → Alert": "detection_to_alert_s",
    "Alert → Operator Notified": "alert_to_notify_s",
    "Notified → Operator Ack": "notify_to_ack_s",
    "Ack → Resolved": "ack_to_resolve_s",
    "Total Response": "total_response_s",
}


def _detections(tables: Tables, site_id: str | None) -> DataFrame:
    return facts_at(tables, "fct_detection_events", site_id)


def detection_kpis(tables: Tables, as_of: AsOf, *, site_id: str | None = None) -> DataFrame:
    """Counts in total and by week, shares over all rows, in one pass and one row.

    The last week has no end and spans eight calendar dates, the previous one seven.
    """
    day = F.col("detection_date")
    last, before = as_of.date_days_ago(7), as_of.date_days_ago(14)
    counted = _detections(tables, site_id).agg(
        F.count(F.lit(1)).alias("total_dets"),
        F.count_if(day >= last).alias("dets_7d"),
        F.count_if((day >= before) & (day < last)).alias("dets_prev_7d"),
        percent_true(F.col("auto_resolved")).alias("auto_resolve_pct"),
        percent_true(F.col("escalated_to_operator")).alias("escalation_pct"),
        percent_true(F.col("false_positive")).alias("fp_pct"),
        percent_mean(F.col("confidence_score")).alias("avg_confidence"),
    )
    return counted.withColumn("dets_delta", F.col("dets_7d") - F.col("dets_prev_7d"))


def latency_overall(
    tables: Tables, *, site_id: str | None = None, accuracy: int | None = None
) -> DataFrame:
    """P50/P95/P99 of the total response in whole seconds; one row, NULLs without alerts."""
    alerts = facts_at(tables, "fct_alert_pipeline_latency", site_id)
    found = percentiles(alerts, {"total": "total_response_s"}, PERCENTILES, accuracy=accuracy)
    return found.select(*[round_half_away(F.col(name), 0).alias(name) for name in PERCENTILES])


def latency_by_stage(
    tables: Tables, *, site_id: str | None = None, accuracy: int | None = None
) -> DataFrame:
    """P50/P95/P99 and mean per stage in seconds; always one row per stage."""
    alerts = facts_at(tables, "fct_alert_pipeline_latency", site_id)
    found = percentiles(alerts, STAGES, PERCENTILES, accuracy=accuracy)
    return found.select(
        F.col("measure").alias("stage"),
        *[round_half_away(F.col(name), 1).alias(name) for name in PERCENTILES],
        round_half_away(F.col("mean"), 1).alias("avg_s"),
    )


def detection_volume(tables: Tables, *, site_id: str | None = None) -> DataFrame:
    """Detections per date and target class."""
    return (
        _detections(tables, site_id)
        .groupBy("detection_date", "target_class")
        .agg(F.count(F.lit(1)).alias("detections"))
        .orderBy(F.asc_nulls_last("detection_date"), F.asc_nulls_last("target_class"))
    )


def detection_breakdown(tables: Tables, *, site_id: str | None = None) -> DataFrame:
    """Per target class, the most frequent first."""
    return (
        _detections(tables, site_id)
        .groupBy("target_class")
        .agg(
            F.count(F.lit(1)).alias("detections"),
            percent_mean(F.col("confidence_score")).alias("avg_confidence_pct"),
            percent_true(F.col("false_positive")).alias("fp_rate_pct"),
        )
        .orderBy(F.desc("detections"), F.asc_nulls_last("target_class"))
    )


def detection_hourly(tables: Tables, *, site_id: str | None = None) -> DataFrame:
    """Per hour of the day."""
    return (
        _detections(tables, site_id)
        .groupBy("hour_of_day")
        .agg(
            F.count(F.lit(1)).alias("detections"),
            percent_true(F.col("escalated_to_operator")).alias("escalation_pct"),
        )
        .orderBy(F.asc_nulls_last("hour_of_day"))
    )


def tower_detection_summary(tables: Tables, *, site_id: str | None = None, length: int = 30) -> DataFrame:
    """The ``length`` towers that escalate the largest share of their detections.

    Summed per tower before the dimension is joined.  Grouping the joined fact by tower
    instead would reuse the join's partitioning, where a hot tower is one task.
    """
    shares = {
        "auto_resolve_pct": F.col("auto_resolved").cast("int"),
        "escalation_pct": F.col("escalated_to_operator").cast("int"),
        "fp_rate_pct": F.col("false_positive").cast("int"),
        # Six digits, so that the sum does not depend on its order; see exact_mean.
        "avg_confidence_pct": F.col("confidence_score").cast("decimal(18,6)"),
    }
    sums = [F.sum(value).alias(f"{name}_sum") for name, value in shares.items()]
    counts = [F.count(value).alias(f"{name}_n") for name, value in shares.items()]
    per_tower = (
        tables["stg_detections"]
        .groupBy("tower_id")
        .agg(F.count(F.lit(1)).alias("n"), *sums, *counts)
    )
    towers = known_towers(tables, site_id, "site_name")
    percentages = [
        round_half_away(
            F.sum(f"{name}_sum").cast("double") / F.nullif(F.sum(f"{name}_n"), F.lit(0)) * 100, 1
        ).alias(name)
        for name in shares
    ]
    return (
        per_tower.join(towers, "tower_id", "left" if site_id is None else "inner")
        .groupBy("tower_id", "site_name")
        .agg(F.sum("n").alias("detections"), *percentages)
        .orderBy(F.desc_nulls_last("escalation_pct"), F.asc_nulls_last("tower_id"), F.asc_nulls_last("site_name"))
        .limit(length)
    )
