"""Full rebuild: raw files -> materialized tables -> checks -> build log."""

from __future__ import annotations

import time
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from watchpost.functions.clock import AsOf
from watchpost.operators.quality import dq_suite
from watchpost.operators.staging import STAGING_MODELS
from watchpost.plans.checks import declared_checks
from watchpost.plans.marts import MARTS
from watchpost.plans.star import DIMENSIONS, StarSchema
from watchpost.sources.lazy import LazyTables
from watchpost.sources.run_log import RUN_LOG, write_run_log
from watchpost.sources.warehouse import materialize, read_tables

# First part of the step ids in the log.
PROJECT = "watchpost"
CONCURRENT_WRITES = 4


def materialize_star(
    spark: SparkSession, raw: Mapping[str, DataFrame], as_of: AsOf | datetime | str, root: str
) -> tuple[LazyTables, dict[str, float]]:
    """Write every model below ``root``; return the written tables and seconds per model.

    Staging is read back before the marts are built on it, and the dimensions before the
    facts, so that raw files are read once and no dimension is computed per fact.  Models
    of one layer do not depend on each other; a few are written at a time, so that a small
    one does not leave the cluster idle.
    """
    seconds: dict[str, float] = {}
    facts = [name for name in MARTS if name not in DIMENSIONS]
    planned = StarSchema(raw, as_of)
    ready: dict[str, DataFrame] = {}
    for layer in (tuple(STAGING_MODELS), DIMENSIONS, facts):
        tables = {name: planned[name] for name in layer}

        @inheritable_thread_target(spark)
        def write(name: str) -> float:
            started = time.perf_counter()
            materialize(tables, root, [name])
            return time.perf_counter() - started

        with ThreadPoolExecutor(CONCURRENT_WRITES) as pool:
            seconds |= dict(zip(layer, pool.map(write, layer)))
        ready |= read_tables(spark, root, {name: planned[name].schema for name in layer})
        planned = StarSchema(raw, as_of, ready)
    return planned, seconds


def rebuild(
    spark: SparkSession, raw: Mapping[str, DataFrame], as_of: AsOf | datetime | str, root: str
) -> LazyTables:
    """Materialize, check, and leave the build log at ``{root}/run_log``."""
    started = time.perf_counter()
    tables, seconds = materialize_star(spark, raw, as_of, root)

    checked = time.perf_counter()
    outcomes = f"{root}/dq_suite"
    dq_suite(tables).coalesce(1).write.mode("overwrite").parquet(outcomes)
    # All checks run as one job; its time is shared out evenly between them.
    share = (time.perf_counter() - checked) / len(declared_checks())

    models = F.array(
        *[_step(F.lit(f"model.{PROJECT}.{n}"), F.lit("success"), F.lit(s)) for n, s in seconds.items()]
    )
    name = F.concat_ws("_", "test", "model", "column_name")
    test_id = F.concat_ws(".", F.lit("test"), F.lit(PROJECT), name)
    # One entry per declared check, so the list has a fixed length.
    tests = F.collect_list(_step(test_id, F.col("status"), F.lit(share)))
    generated_at = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    log = (
        spark.read.parquet(outcomes)
        .agg(tests.alias("tests"))
        .select(
            F.struct(F.lit(generated_at).alias("generated_at")).alias("metadata"),
            F.lit(None).cast("string").alias("generated_at"),
            F.lit(time.perf_counter() - started).alias("elapsed_time"),
            F.concat(models, "tests").cast(RUN_LOG["results"].dataType).alias("results"),
        )
    )
    write_run_log(log, f"{root}/run_log")
    return tables


def _step(unique_id, status, seconds):
    return F.struct(
        unique_id.alias("unique_id"), status.alias("status"), seconds.alias("execution_time")
    )
