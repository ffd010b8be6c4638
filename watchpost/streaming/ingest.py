"""Staging kept up to date from a landing folder.

A full refresh re-reads everything each time.  For the append-only sources the same
staging selects run as a stream: each call stages only files that arrived since the
last one.  Progress lives in the checkpoint folder, so a lost driver or executor neither
skips nor repeats a file.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from watchpost.operators.staging import stage
from watchpost.sources.schemas import staging_schema

# Append-only sources and the time that dates their rows.
EVENT_TIME = {
    "telemetry": "ts",
    "detections": "detected_at",
    "alert_pipeline": "detection_ts",
}


def staged_stream(
    spark: SparkSession, name: str, landing: str, *, files_at_once: int | None = None
) -> DataFrame:
    """Streaming staging table over parquet files landing in a folder, all that is there at once or
    so many files at a time.

    Read with the types that the landed files declare, and cast by the staging select like a
    batch: a stream that insists on the target types refuses files of other integer widths.  A
    folder that is still empty gives the target types.
    """
    try:
        found = spark.read.parquet(landing).schema
    except AnalysisException:  # nothing has landed yet
        found = staging_schema(name)
    reader = spark.readStream.schema(found)
    if files_at_once is not None:
        reader = reader.option("maxFilesPerTrigger", files_at_once)
    return stage(name, reader.parquet(landing))


def ingest_available(
    spark: SparkSession, name: str, landing: str, table: str, checkpoint: str
) -> StreamingQuery:
    """Append all files not yet staged to ``table``, by date, then stop."""
    dated = staged_stream(spark, name, landing).withColumn("date", F.to_date(EVENT_TIME[name]))
    return (
        dated.writeStream.format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .partitionBy("date")
        .trigger(availableNow=True)
        .start()
    )
