"""Folders on whatever file system the session uses."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, files = _resolve(spark, path)
    return files.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    target, files = _resolve(spark, path)
    files.delete(target, True)


def modified(spark: SparkSession, path: str) -> float:
    """When a file was last written, in seconds since the epoch."""
    target, files = _resolve(spark, path)
    return files.getFileStatus(target).getModificationTime() / 1000


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies directly in a folder; nothing if there is no such folder."""
    target, files = _resolve(spark, path)
    if not files.exists(target):
        return []
    return [status.getPath().getName() for status in files.listStatus(target)]


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; one is made up only on one machine."""
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoint-")
        context.setCheckpointDir(folder)
    return folder


def new_table_path(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tables/{uuid.uuid4()}"
