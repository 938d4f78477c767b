"""The folder that every executor can reach, for checkpoints and written tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


@cache
def _local_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="tablecraft-")


def _one_machine(master: str) -> bool:
    """``local`` and ``local[n]`` run in one process; ``local-cluster[...]`` does not."""
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``, else the one given to
    ``SparkContext.setCheckpointDir``; a temporary one only in local mode."""
    folder = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not _one_machine(context.master):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    return _local_folder(context.applicationId)


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _delete_at_end(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)


def settled(frame: DataFrame, label: str = "settled") -> DataFrame:
    """The same rows, written once as Parquet below the shared folder and read from there.

    Later jobs neither recompute them nor see another order of rows after an executor is
    lost, which matters to whatever draws rows at random. The files go when the session's
    process ends.
    """
    spark = frame.sparkSession
    folder = new_folder(spark, label)
    frame.write.parquet(folder)
    _delete_at_end(spark, folder)
    return spark.read.schema(frame.schema).parquet(folder)
