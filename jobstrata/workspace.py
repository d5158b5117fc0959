"""Where jobs put intermediate results: the checkpoint folder all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


def work_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a fresh temporary one only in local mode."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="run-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """An unused path below the work folder, or below the scratch folder in use."""
    folder = _SCRATCH.get() or work_folder(spark)
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A folder for the steps of one job, removed at its end. What is computed from them has
    to be stored elsewhere before."""
    path = new_path(spark, "scratch")
    outer = _SCRATCH.set(path)
    try:
        yield path
    finally:
        _SCRATCH.reset(outer)
        remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system that Spark reaches; one that is not there is no error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def materialise(df: DataFrame, name: str = "step") -> DataFrame:
    """Compute ``df`` once into the work folder, as Parquet, and read it from there."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
