"""Build logs: JSON documents ``{metadata, elapsed_time, results: [...]}``.

A folder may hold one pretty-printed document per file (``multiline=True``) or one
document per line, which Spark can split between tasks.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

# The fields of a log document.
STEP = StructType().add("unique_id", "string").add("status", "string").add("execution_time", "double")
RUN_LOG = (
    StructType()
    .add("metadata", StructType().add("generated_at", "string"))
    .add("generated_at", "string")
    .add("elapsed_time", "double")
    .add("results", ArrayType(STEP))
)
# Holds the text of a document that is no log, in full or in part; NULL for all others.
UNREADABLE = "unreadable"
READ_LOG = StructType(RUN_LOG.fields).add(UNREADABLE, "string")


def read_run_log(spark: SparkSession, path: str, *, multiline: bool = True) -> DataFrame:
    """One row per log document; no rows when there is no log at ``path``.

    A document that cannot be read keeps its row, with its text as ``unreadable``.  Spark lists
    no file of zero bytes, so such a file is no document.
    """
    try:
        # As text, so that files and rows of text are read by one rule.
        return parse_run_log(spark.read.text(path, wholetext=multiline).select("value"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], READ_LOG)


def parse_run_log(lines: DataFrame, column: str = "value") -> DataFrame:
    """Log documents from a text column, one JSON document per row (a table, a stream)."""
    text = F.col(column)
    log = F.from_json(text, READ_LOG, {"columnNameOfCorruptRecord": UNREADABLE})
    parsed = lines.select(log.alias("log"), text.alias("document"))
    # An empty document gives no struct at all, and one of white space an empty one.
    document = F.coalesce("document", F.lit(""))
    broken = F.when(document.rlike(r"^\s*$"), document)
    return parsed.select(
        *[F.col(f"log.{name}") for name in RUN_LOG.fieldNames()],
        F.coalesce(f"log.{UNREADABLE}", broken).alias(UNREADABLE),
    )


def write_run_log(log: DataFrame, path: str) -> None:
    """One document per line."""
    log.select(*RUN_LOG.fieldNames()).write.mode("overwrite").json(path)
