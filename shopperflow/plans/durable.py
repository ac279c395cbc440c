"""Writing an intermediate result to shared storage, so later steps neither recompute nor lose it."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """The folder named in spark.checkpoint.dir; where that is unset, one inside the warehouse."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the checkpoint folder, for tables written between two jobs."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{purpose}-{uuid.uuid4().hex}"


def _file(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def remove_folder(spark: SparkSession, path: str) -> None:
    files, where = _file(spark, path)
    files.delete(where, True)


def modified(spark: SparkSession, path: str) -> int | None:
    """When the file or folder was last changed (milliseconds), None if there is none."""
    files, where = _file(spark, path)
    return files.getFileStatus(where).getModificationTime() if files.exists(where) else None


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder, sorted; none if there is no such folder."""
    files, where = _file(spark, path)
    return sorted(entry.getPath().getName() for entry in files.listStatus(where)) if files.exists(where) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, whole."""
    files, where = _file(spark, path)
    stream = files.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file that is seen whole or not at all; refuses to replace one."""
    files, where = _file(spark, path)
    _, draft = _file(spark, f"{path}.{uuid.uuid4().hex}.draft")
    stream = files.create(draft, False)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    if files.exists(where) or not files.rename(draft, where):
        files.delete(draft, False)
        raise FileExistsError(path)


@contextmanager
def passing_folder(spark: SparkSession, purpose: str) -> Iterator[str]:
    """A shared folder that is gone at the end; settle() inside what is to outlive it."""
    folder = shared_folder(spark, purpose)
    try:
        yield folder
    finally:
        remove_folder(spark, folder)


def settle(df: DataFrame) -> DataFrame:
    """Compute `df` once into the checkpoint folder and carry on from those files."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
