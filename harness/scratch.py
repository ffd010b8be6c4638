"""Folders for tables that a query writes and reads again."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from functools import cache

from pyspark.sql import SparkSession

from watchpost.sources.warehouse import new_folder


@cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="watchpost-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``.

    A local session without that setting gets a folder that goes when this process ends; the
    session's settings stay as they are.
    """
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.master.startswith("local["):
        return f"{tempfile.mkdtemp(prefix=purpose + '-', dir=_own_folder())}/table"
    return new_folder(spark, purpose)
