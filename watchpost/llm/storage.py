"""Intermediate tables in the folder that driver and executors share, and broadcasts by value."""

from __future__ import annotations

import atexit
import pickle
import shutil
import tempfile
import uuid
from functools import cache

from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession


@cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="watchpost-llm-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset, only a local session may go on,
    whose executors are the driver: it gets a folder that goes when this process ends."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _own_folder()


def new_folder(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, computed once and read by column.

    The table belongs to whoever manages that folder: results that are still unread may need
    it, so it isn't removed here.
    """
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df.checkpoint()`` in the shared folder: lineage ends here and lost executors don't matter."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def shared_value(spark: SparkSession, value: object) -> Broadcast:
    """A broadcast with the classes of ``value`` in it, so that executors need no copy of this package."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def value_of(shared: Broadcast) -> object:
    """The value of ``shared_value``, in a task."""
    return pickle.loads(shared.value)
