"""Registered queries: every operator over the mapped driver tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harness.mapping import AS_OF, raw_tables, run_logs
from harness.scratch import scratch_folder
from watchpost.functions.clock import AsOf
from watchpost.operators import detection, header, health, lifecycle, operations, quality, reliability, rules, sketches, timelines
from watchpost.plans.incremental import HealthMart
from watchpost.plans.rebuild import materialize_star
from watchpost.plans.star import MODEL_NAMES, StarSchema
from watchpost.sources.run_log import parse_run_log, read_run_log
from watchpost.sources.warehouse import write_table
from watchpost.streaming import windows

Query = Callable[[SparkSession, str], DataFrame]

# Landing of the streamed detections, valid in Spark SQL and DuckDB: by thirds of the month, every
# tenth one batch late; rows later than the delay come too late.
LANDS_IN = """(case when day(detected_at) <= 10 then 0 when day(detected_at) <= 20 then 1 else 2 end
  + case when cast(substr(detection_id, 4) as bigint) % 10 = 0 then 1 else 0 end)"""
STREAM_WINDOW, STREAM_DELAY_DAYS = "6 hours", 5
MOMENT = AsOf.of(AS_OF)
# A site of the driver's tables with towers, detections and incidents, and one without any tower.
SITE, EMPTY_SITE = "S05", "S22"
# Ranges answered from sketches: a name, the first day, a site.
SKETCHED = (("all", None, None), ("last", "2024-01-24", None), ("site", None, SITE))


def star(spark: SparkSession, sf_dir: str) -> StarSchema:
    """All models, planned: dimensions are computed in the query that needs them."""
    return StarSchema(raw_tables(spark, sf_dir), MOMENT)


def _model(name: str) -> Query:
    return lambda spark, sf_dir: star(spark, sf_dir)[name]


def _on_star(operator: Callable[..., DataFrame], *args, **options) -> Query:
    return lambda spark, sf_dir: operator(star(spark, sf_dir), *args, **options)


def _logged(operator: Callable[[DataFrame], DataFrame]) -> Query:
    """The operator over build logs that arrive as JSON text."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        lines = run_logs(spark, sf_dir).select(F.to_json(F.struct("*")).alias("value"))
        return operator(parse_run_log(lines))

    return query


def log_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps of build logs that lie in files, one document in each, spread over lines."""
    folder = scratch_folder(spark, "logs")
    document = F.to_json(F.struct("*"), {"pretty": "true"}).alias("value")
    run_logs(spark, sf_dir).select(document).write.option("maxRecordsPerFile", 1).text(folder)
    return health.run_log_steps(read_run_log(spark, folder, multiline=True))


def detection_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final windows of detections that land in four batches, some of them one batch late."""
    folder = scratch_folder(spark, "windows")
    landing, table, checkpoint = (f"{folder}/{part}" for part in ("landing", "table", "checkpoint"))
    landed = spark.sql(f"select *, {LANDS_IN} as batch from {{d}}", d=raw_tables(spark, sf_dir)["detections"])
    for batch in range(4):
        landed.where(F.col("batch") == batch).drop("batch").write.mode("append").parquet(landing)
        run = windows.count_available(
            spark, landing, table, checkpoint, window=STREAM_WINDOW, delay=f"{STREAM_DELAY_DAYS} days"
        )
        run.awaitTermination()
    return spark.read.parquet(table).drop("date")


def health_by_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily fleet health from five batches that each hold rows of all days."""
    tables = star(spark, sf_dir)
    mart = HealthMart(spark, scratch_folder(spark, "health"), tables).create()
    readings = tables["stg_telemetry"].withColumn("batch", F.pmod(F.xxhash64("tower_id", "ts"), F.lit(3)))
    incidents = tables["stg_incidents"].withColumn("batch", F.pmod(F.xxhash64("incident_id"), F.lit(2)))
    for k in (1, 0, 2):
        mart.apply(f"telemetry-{k}", telemetry=readings.where(F.col("batch") == k).drop("batch"))
        if k < 2:
            mart.apply(f"incidents-{k}", incidents=incidents.where(F.col("batch") == k).drop("batch"))
    return mart.table()


def sketched_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of ranges of days from stored sketches: whether their ranks are within the error."""
    tables = star(spark, sf_dir)
    path = f"{scratch_folder(spark, 'sketches')}/response"
    write_table(sketches.response_sketches(tables), path, partition_by="detection_date")
    stored = spark.read.parquet(path)
    alerts, day = tables["fct_alert_pipeline_latency"], F.col("detection_date")
    rows = []
    for name, first, site in SKETCHED:
        begin = date.fromisoformat(first) if first else None
        answers = sketches.percentiles_between(stored, begin, site_id=site)
        chosen = alerts if begin is None else alerts.where(day >= F.lit(begin))
        errors = sketches.rank_errors(chosen if site is None else chosen.where(F.col("site_id") == site), answers)
        right = [(F.col(p) <= sketches.RANK_ERROR).alias(f"{p}_right") for p in detection.PERCENTILES]
        rows.append(errors.select(F.lit(name).alias("days"), "stage", "n", *right))
    return reduce(DataFrame.unionByName, rows)


def _checksum(table: DataFrame) -> Column:
    """Sum over all rows of a hash of all values in order, the same in any order of rows."""

    def text(field) -> Column:
        value = F.col(field.name)
        value = value.cast("decimal(18,6)") if field.dataType.simpleString() == "double" else value
        return F.coalesce(value.cast("string"), F.lit("~"))

    row = F.md5(F.concat_ws("|", *[text(field) for field in table.schema]))
    return F.coalesce(F.sum(F.conv(F.substring(row, 1, 8), 16, 10).cast("bigint")), F.lit(0))


def materialize_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and checksums of all models, read from the tables written to disk."""
    root = scratch_folder(spark, "star")
    tables, _ = materialize_star(spark, raw_tables(spark, sf_dir), MOMENT, root)
    counts = [
        tables[name]
        .agg(F.count(F.lit(1)).alias("row_count"), _checksum(tables[name]).alias("checksum"))
        .select(F.lit(name).alias("model"), "row_count", "checksum")
        for name in MODEL_NAMES
    ]
    return reduce(DataFrame.unionByName, counts)


# Queries that take the site filter, with what they need besides.
SITE_FILTERED: dict[str, tuple[Callable[..., DataFrame], tuple]] = {
    "site_status": (operations.site_status, ()),
    "site_status_density": (operations.site_status_density, (MOMENT,)),
    "active_missions": (operations.active_missions, ()),
    "open_incidents": (operations.open_incident_list, (MOMENT,)),
    "det_kpi": (detection.detection_kpis, (MOMENT,)),
    "latency_overall": (detection.latency_overall, ()),
    "det_volume": (detection.detection_volume, ()),
    "det_breakdown": (detection.detection_breakdown, ()),
    "det_hourly": (detection.detection_hourly, ()),
    "latency_by_stage": (detection.latency_by_stage, ()),
    "tower_detection_summary": (detection.tower_detection_summary, ()),
    "mtbf_by_subsystem": (reliability.mtbf_by_subsystem, ()),
    "uptime_trend": (reliability.uptime_trend, ()),
    "incidents_by_category": (reliability.incidents_by_category, (MOMENT,)),
    "top_root_causes": (reliability.top_root_causes, ()),
    "remaining_life": (lifecycle.remaining_life, ()),
    "replacement_queue": (lifecycle.replacement_queue, (MOMENT,)),
}
# Also asked for a site that has no tower, where they must not fail.
AT_EMPTY_SITE = ("det_kpi", "latency_by_stage", "site_status_density", "tower_detection_summary")

QUERIES: dict[str, Query] = {
    **{name: _model(name) for name in MODEL_NAMES},
    "materialize_roundtrip": materialize_roundtrip,
    # business rules
    "rule_auto_resolve": _on_star(rules.rule_auto_resolve),
    "rule_overnight": _on_star(rules.rule_overnight),
    "escalation_queue": _on_star(rules.escalation_queue),
    "escalation_gaps": _on_star(rules.escalation_gaps),
    "stage_latencies_from_ts": _on_star(rules.stage_latencies),
    "latest_deployment_per_tower": _on_star(rules.latest_deployment_per_tower),
    # header
    "site_filtered_kpis": _on_star(header.kpi_header, MOMENT, site_id=SITE),
    "empty_site_kpis": _on_star(header.kpi_header, MOMENT, site_id=EMPTY_SITE),
    "site_options": _on_star(header.site_options),
    "last_telemetry": _on_star(header.last_telemetry),
    "kpi_active_towers": _on_star(header.active_towers),
    "kpi_active_deployments": _on_star(header.active_deployments),
    "kpi_open_incidents": _on_star(header.open_incidents),
    "kpi_uptime": _on_star(header.uptime, MOMENT),
    "kpi_failures": _on_star(header.failures, MOMENT),
    "kpi_backlog_7d_ago": _on_star(header.backlog_7d_ago, MOMENT),
    "kpi_header": _on_star(header.kpi_header, MOMENT),
    # operations
    "site_status": _on_star(operations.site_status),
    "det_density": _on_star(operations.detection_density, MOMENT),
    "site_status_density": _on_star(operations.site_status_density, MOMENT),
    "active_missions": _on_star(operations.active_missions),
    "open_incidents": _on_star(operations.open_incident_list, MOMENT),
    "low_inventory": _on_star(operations.low_inventory),
    # detections
    "det_kpi": _on_star(detection.detection_kpis, MOMENT),
    "latency_overall": _on_star(detection.latency_overall),
    "det_volume": _on_star(detection.detection_volume),
    "det_breakdown": _on_star(detection.detection_breakdown),
    "det_hourly": _on_star(detection.detection_hourly),
    "latency_by_stage": _on_star(detection.latency_by_stage),
    "tower_detection_summary": _on_star(detection.tower_detection_summary),
    # reliability
    "mtbf_by_subsystem": _on_star(reliability.mtbf_by_subsystem),
    "mtbf_long": _on_star(reliability.mtbf_long),
    "uptime_trend": _on_star(reliability.uptime_trend),
    "uptime_long": _on_star(reliability.uptime_long),
    "incidents_by_category": _on_star(reliability.incidents_by_category, MOMENT),
    "top_root_causes": _on_star(reliability.top_root_causes),
    # batches and streams
    "health_by_batches": health_by_batches,
    "detection_windows": detection_windows,
    "sketched_percentiles": sketched_percentiles,
    # component lifecycle
    "component_survival": _on_star(lifecycle.component_survival),
    "remaining_life": _on_star(lifecycle.remaining_life),
    "replacement_queue": _on_star(lifecycle.replacement_queue, MOMENT),
    # along time
    "tower_state_at_detection": _on_star(timelines.tower_state_at_detection),
    "missions_at_detection": _on_star(timelines.missions_at_detection, MOMENT),
    "telemetry_outages": _on_star(timelines.telemetry_outages, MOMENT),
    "telemetry_sessions": _on_star(timelines.telemetry_sessions, MOMENT),
    "backlog_by_day": _on_star(timelines.backlog_by_day, MOMENT),
    "detection_kpis_by_level": _on_star(timelines.detection_kpis_by_level, MOMENT),
    # pipeline health
    "source_freshness": _on_star(health.source_freshness, MOMENT),
    "freshness_status": _on_star(health.freshness_status, MOMENT),
    "run_log_steps": _logged(health.run_log_steps),
    "run_log_summary": _logged(health.run_log_summary),
    "pipeline_status": _logged(health.pipeline_status),
    "run_log_files": log_files,
    # data quality
    "dq_not_null": _on_star(quality.dq_not_null),
    "dq_unique": _on_star(quality.dq_unique),
    "dq_accepted_values": _on_star(quality.dq_accepted_values),
    "dq_relationships": _on_star(quality.dq_relationships),
    "dq_suite": _on_star(quality.dq_suite),
    # with the site filter
    **{f"{name}_at_site": _on_star(f, *more, site_id=SITE) for name, (f, more) in SITE_FILTERED.items()},
    **{
        f"{name}_at_empty_site": _on_star(SITE_FILTERED[name][0], *SITE_FILTERED[name][1], site_id=EMPTY_SITE)
        for name in AT_EMPTY_SITE
    },
}
