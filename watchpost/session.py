"""Session settings the operators are designed for.  Any Spark 4 session works."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Runtime re-planning: join strategy from real sizes, coalescing, skew splits.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot tower even if an aggregate after the join then needs its own shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder
