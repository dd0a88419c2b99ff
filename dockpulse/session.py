"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "dockpulse", master: str | None = None, **settings: object) -> SparkSession:
    """A session with UTC zone and adaptive execution; sizing is left to the submitter."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local master may fall back to a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a DataFrame under the shared folder and read it back.

    Cuts lineage in a way that survives lost executors, and gives later joins exact sizes.
    """
    return _stage_at(df, work_path(df.sparkSession, name))


@contextmanager
def staged_for_use(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """As ``stage``, for a block of code; the files are deleted when it ends."""
    path = work_path(df.sparkSession, name)
    try:
        yield _stage_at(df, path)
    finally:
        file_system, target = hadoop_path(df.sparkSession, path)
        file_system.delete(target, True)


def _stage_at(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hadoop_path(spark: SparkSession, path: str):
    """The Hadoop ``FileSystem`` and ``Path`` for a location, for existence tests and deletes."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    file_system, target = hadoop_path(spark, path)
    return file_system.exists(target)


def swap_folder(spark: SparkSession, following: str, current: str, previous: str) -> None:
    """Put ``following`` in the place of ``current``; the old folder is deleted last."""
    file_system, target = hadoop_path(spark, current)
    kept, new = (hadoop_path(spark, p)[1] for p in (previous, following))
    if not file_system.rename(target, kept):
        raise OSError(f"could not move {current} aside")
    if not file_system.rename(new, target):
        file_system.rename(kept, target)
        raise OSError(f"could not move {following} into place")
    file_system.delete(kept, True)


def count_files(spark: SparkSession, path: str, pattern: str) -> int:
    """Number of files directly in a folder that match a glob; 0 when there is no such folder."""
    file_system, _ = hadoop_path(spark, path)
    found = file_system.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, pattern)) or []
    return sum(status.isFile() for status in found)


def move_one(spark: SparkSession, folder: str, target: str) -> None:
    """Move the only data file of a folder that Spark wrote to another name, and delete the folder."""
    file_system, source = hadoop_path(spark, folder)
    files = [s.getPath() for s in file_system.listStatus(source) if s.getPath().getName().startswith("part-")]
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    file_system.mkdirs(where.getParent())
    if len(files) != 1 or not file_system.rename(files[0], where):
        raise OSError(f"could not move the file of {folder} to {target}")
    file_system.delete(source, True)


def child_folders(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """Sorted names of the folders directly below a path that match a glob."""
    file_system, _ = hadoop_path(spark, path)
    glob = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, pattern)
    found = file_system.globStatus(glob) or []
    return sorted(status.getPath().getName() for status in found if status.isDirectory())
