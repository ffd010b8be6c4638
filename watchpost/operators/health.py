"""Pipeline health: age of the sources and outcome of the builds."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchpost.functions.clock import AsOf, minutes_between, seconds_elapsed
from watchpost.functions.numeric import exact_mean, round_exact, round_half_even

Tables = Mapping[str, DataFrame]

# Sources shown with their age, sources with a threshold, the thresholds
# in hours, and the outcomes that count as passed or as neither passed nor failed.
AGE_SHOWN = {
    "telemetry": "ts",
    "incidents": "opened_at",
    "deployments": "start_ts",
    "inventory": "last_updated",
}
AGE_CHECKED = {
    "telemetry": "ts",
    "detections": "detected_at",
    "alert_pipeline": "detection_ts",
}
WARN_AFTER_HOURS = 6
ERROR_AFTER_HOURS = 24
PASSED = ("pass", "success")
SKIPPED = ("skipped",)

# Codes that say why a build has its status.
NO_LOG, EMPTY, OK, FAILED, UNREADABLE = "no_log", "empty", "ok", "failed", "unreadable"


def _last_records(tables: Tables, columns: Mapping[str, str]) -> DataFrame:
    newest = [
        tables[f"stg_{source}"].agg(F.max(column).alias("last_ts")).withColumn("source", F.lit(source))
        for source, column in columns.items()
    ]
    return reduce(DataFrame.unionByName, newest)


def source_freshness(tables: Tables, as_of: AsOf) -> DataFrame:
    """Last record and its age in minutes per source; NULLs for an empty source."""
    age = minutes_between(F.col("last_ts"), as_of.now())
    return (
        _last_records(tables, AGE_SHOWN)
        .select("source", "last_ts", age.alias("age_minutes"))
        .orderBy("source")
    )


def freshness_status(tables: Tables, as_of: AsOf) -> DataFrame:
    """pass / warn / error by age of the last record; an empty source is an error."""
    hours = seconds_elapsed(F.col("last_ts"), as_of.now()) / 3600.0
    status = (
        F.when(hours.isNull() | (hours > ERROR_AFTER_HOURS), "error")
        .when(hours > WARN_AFTER_HOURS, "warn")
        .otherwise("pass")
    )
    return _last_records(tables, AGE_CHECKED).select(
        "source", "last_ts", hours.alias("age_hours"), status.alias("status")
    )


def _passed(status: Column) -> Column:
    return F.coalesce(status.isin(*PASSED), F.lit(False))


def _failed(status: Column) -> Column:
    """Neither passed nor skipped; a step without a status has failed."""
    return ~F.coalesce(status.isin(*PASSED, *SKIPPED), F.lit(False))


def run_log_steps(log: DataFrame) -> DataFrame:
    """One row per step of each logged build."""
    step = F.col("step")
    parts = F.split(F.coalesce(step["unique_id"], F.lit("")), "[.]")
    seconds = F.coalesce(step["execution_time"], F.lit(0.0))
    return log.select(_generated_at(log), F.explode("results").alias("step")).select(
        "generated_at",
        F.element_at(parts, 1).alias("kind"),
        F.element_at(parts, -1).alias("name"),
        step["status"].alias("status"),
        seconds.alias("seconds"),
    ).select("generated_at", "kind", "name", "status", round_exact(F.col("seconds"), 3).alias("elapsed_s"))


def run_log_summary(log: DataFrame) -> DataFrame:
    """Steps, outcomes and mean time per kind of step."""
    status = F.col("status")
    return (
        run_log_steps(log)
        .groupBy("kind")
        .agg(
            F.count(F.lit(1)).alias("steps"),
            F.count_if(_passed(status)).alias("passed"),
            F.count_if(_failed(status)).alias("failed"),
            round_half_even(exact_mean(F.col("elapsed_s")), 3).alias("avg_s"),
        )
        .orderBy("kind")
    )


def pipeline_status(log: DataFrame) -> DataFrame:
    """Verdict per logged build; a single warning row when nothing is logged.

    Only a build whose every step passed is ``ok``: a skipped step turns it to ``fail``
    although it is not counted in ``failed``.  A log that cannot be read fails too.
    """
    broken = F.col("unreadable").isNotNull() if "unreadable" in log.columns else F.lit(False)
    steps = F.coalesce(F.col("results"), F.array().cast(log.schema["results"].dataType))
    verdict = (
        F.when(F.col("broken"), "fail")
        .when(F.col("n_total") == 0, "warn")
        .when(F.col("n_passed") == F.col("n_total"), "ok")
        .otherwise("fail")
    )
    detail = (
        F.when(F.col("broken"), UNREADABLE)
        .when(F.col("n_total") == 0, EMPTY)
        .when(F.col("n_passed") == F.col("n_total"), OK)
        .otherwise(FAILED)
    )
    logged = log.where(
        F.coalesce("metadata.generated_at", "generated_at").isNotNull()
        | F.col("elapsed_time").isNotNull()
        | F.col("results").isNotNull()
        | broken
    )
    builds = logged.select(
        _generated_at(log),
        broken.alias("broken"),
        F.size(steps).alias("n_total"),
        F.size(F.filter(steps, lambda s: _passed(s["status"]))).alias("n_passed"),
        F.size(F.filter(steps, lambda s: _failed(s["status"]))).alias("n_failed"),
        F.coalesce("elapsed_time", F.lit(0.0)).alias("elapsed_s"),
    ).select(
        verdict.alias("status"),
        detail.alias("detail"),
        *[F.col(n).cast("bigint").alias(n) for n in ("n_total", "n_passed", "n_failed")],
        "elapsed_s",
        "generated_at",
    )
    nothing = logged.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == 0).select(
        F.lit("warn").alias("status"),
        F.lit(NO_LOG).alias("detail"),
        *[F.lit(0).cast("bigint").alias(n) for n in ("n_total", "n_passed", "n_failed")],
        F.lit(0.0).alias("elapsed_s"),
        F.lit("").alias("generated_at"),
    )
    return builds.unionByName(nothing)


def _generated_at(log: DataFrame) -> Column:
    """Build time: below ``metadata``, or at the top of older logs."""

    def text(name: str) -> Column:
        return F.nullif(F.col(name), F.lit(""))

    return F.coalesce(text("metadata.generated_at"), text("generated_at"), F.lit("")).alias("generated_at")
