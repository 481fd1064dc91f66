"""Folder listing through Hadoop's file system, so any store Spark can write to works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _locate(spark: SparkSession, path: str):
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()), target


def committed(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    """Numbers of the folders ``<prefix>N`` below ``folder`` whose write has finished, ascending.

    A Spark write leaves its ``_SUCCESS`` marker last, so an unfinished folder has none.
    """
    fs, pattern = _locate(spark, f"{folder}/{prefix}*/_SUCCESS")
    names = [s.getPath().getParent().getName() for s in fs.globStatus(pattern) or []]
    return sorted(int(name.removeprefix(prefix)) for name in names)


def ensure_folder(spark: SparkSession, path: str) -> str:
    """Create the folder if it is absent, so that a stream can wait for its first file."""
    fs, target = _locate(spark, path)
    fs.mkdirs(target)
    return path


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, target = _locate(spark, path)
    fs.delete(target, True)


def names(spark: SparkSession, pattern: str) -> list[str]:
    """Names of the files and folders that match a glob pattern."""
    fs, target = _locate(spark, pattern)
    return [s.getPath().getName() for s in fs.globStatus(target) or []]


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _locate(spark, path)
    return fs.exists(target)


def create(spark: SparkSession, path: str) -> bool:
    """Create an empty file; false if there is one already, so of several callers one gets true."""
    fs, target = _locate(spark, path)
    fs.mkdirs(target.getParent())
    return fs.createNewFile(target)


def move_folder(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder; ``to`` must not exist. On HDFS and local disks nobody sees a part of it."""
    fs, source = _locate(spark, path)
    _, target = _locate(spark, to)
    fs.mkdirs(target.getParent())
    if fs.exists(target) or not fs.rename(source, target):
        raise OSError(f"cannot move {path} to {to}")


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, such as the metadata of a checkpoint."""
    fs, target = _locate(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()
