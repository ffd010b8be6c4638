"""Raw sources: one parquet file or folder per table, ``{root}/{name}.parquet``."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from watchpost.sources.schemas import RAW_TABLES


def read_raw(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The raw tables that are there, with the types their files declare; staging pins them.

    A missing file or folder is a missing table; any other fault is an error.
    """
    found = {}
    for name in RAW_TABLES:
        try:
            found[name] = spark.read.parquet(f"{root}/{name}.parquet")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return found


def allow_nanosecond_files(spark: SparkSession) -> None:
    """Let this session open parquet files with nanosecond timestamps.

    Such files (pandas writes them) are otherwise rejected.  Their timestamps arrive as
    bigint nanoseconds, which staging turns back into timestamps.  The switch is a
    session setting in Spark, not a reader option, so it is left to the caller.
    """
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
