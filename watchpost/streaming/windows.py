"""Detections per class in event-time windows, kept up to date from a landing folder.

Rows are counted by the time they carry, not by the time they arrive.  The watermark trails the
latest time seen by ``delay``: a window whose end it has passed is final and is written, once; a row
that arrives later for such a window is dropped.  Until then, windows live in keyed state, one row
per window and class, so memory grows with open windows, not with detections.  Rows are added up in
their tasks before they are shuffled to the state, so a class or an hour with most of the rows is
one row per task there.

``count_available`` takes what has landed and stops; the checkpoint folder keeps the state, the
watermark and which files were taken.  A run that was lost after it wrote, before it noted so, is
repeated under the same number, and its output counts once.  The number of state partitions is that
of the first run: choose ``spark.sql.shuffle.partitions`` for the size of the stream before it.

Edge cases: a detection without a time is never late and in no window: left out; without a class
it is in the null class; repeated rows count each; windows begin at whole multiples of their length
since 1970, without a zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from watchpost.streaming.ingest import staged_stream

WINDOW = "1 hour"
DELAY = "2 hours"


# Watermarks are instants: times without a zone are taken as UTC, whatever the session's zone is.
def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _instant(zoneless: Column) -> Column:
    # The difference of two zone-less times, unlike timestamp_diff, has nothing to do with a zone.
    seconds = (zoneless - _epoch()).cast("interval second").cast("decimal(18,6)")
    return F.timestamp_micros((seconds * 1_000_000).cast("long"))


def _zoneless(instant: Column) -> Column:
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), _epoch())


def class_windows(detections: DataFrame, *, window: str = WINDOW, delay: str | None = DELAY) -> DataFrame:
    """Per window and class: detections, escalations, false positives and summed confidence.

    The same plan serves a stream, with ``delay``, and a table, where there is none.  Sums are of
    six-digit decimals and don't depend on order.
    """
    timed = detections.where("detected_at is not null").withColumn("__event", _instant(F.col("detected_at")))
    timed = timed if delay is None else timed.withWatermark("__event", delay)
    counted = timed.groupBy(F.window("__event", window).alias("window"), "target_class").agg(
        F.count(F.lit(1)).alias("detections"),
        F.count_if("escalated_to_operator").alias("escalations"),
        F.count_if("false_positive").alias("false_positives"),
        F.sum(F.col("confidence_score").cast("decimal(18,6)")).cast("double").alias("confidence_sum"),
    )
    return counted.select(
        _zoneless(F.col("window.start")).alias("window_start"),
        _zoneless(F.col("window.end")).alias("window_end"),
        *counted.columns[1:],
    )


def count_available(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    *,
    window: str = WINDOW,
    delay: str = DELAY,
    files_at_once: int | None = None,
) -> StreamingQuery:
    """Take all detections that have landed, append the windows that are final to ``table``, stop.

    With ``files_at_once`` a run takes them in steps of so many files, oldest first, and the
    watermark moves after each step; without it, all that is there is one step.
    """
    stream = staged_stream(spark, "detections", landing, files_at_once=files_at_once)
    counted = class_windows(stream, window=window, delay=delay)
    return (
        counted.withColumn("date", F.to_date("window_start"))
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .partitionBy("date")
        .trigger(availableNow=True)
        .start()
    )

