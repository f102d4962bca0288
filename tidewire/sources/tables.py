"""Parquet tables and shared working folders."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Work folder of local sessions that name none.
LOCAL_FOLDER = "/tmp/checkpoints/tidewire"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Read ``folder/name.parquet``. A small file is spread over more tasks with ``spark.sql.files.maxPartitionBytes``."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session may leave it unset; it then uses ``LOCAL_FOLDER``.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not configured:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
            configured = LOCAL_FOLDER
        context.setCheckpointDir(configured)
    return (configured or context.getCheckpointDir()).rstrip("/")


#: Whether Spark removes the shuffle files of an execution at its end.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is shuffled for a result that is written here is not read again and goes at its end, not when the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors and ends the lineage."""
    shared_folder(df.sparkSession)
    with _shuffles_removed(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # a plan of its own, which owns its shuffles


def written(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """``df`` as a Parquet table of its own, compressed, and the folder to give to ``remove`` when nothing reads it any more."""
    path = work_folder(df.sparkSession, purpose)
    with _shuffles_removed(df.sparkSession):
        df.select("*").write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of ``written``, in whatever store it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared one."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
