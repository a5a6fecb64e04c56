"""Folders of the shared store, through Hadoop's file system classes."""

from __future__ import annotations

from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of a URI."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def exists(spark: SparkSession, path: str) -> bool:
    store, found = hadoop_path(spark, path)
    return store.exists(found)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    store, found = hadoop_path(spark, path)
    return [f.getPath().getName() for f in store.listStatus(found)] if store.exists(found) else []


def files_below(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, length, modification time) of every file in a folder and below,
    or of the one file."""
    store, found = hadoop_path(spark, path)
    listed, out = store.listFiles(found, True), []
    while listed.hasNext():
        f = listed.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(out)


def values(spark: SparkSession, path: str, key: str) -> list[str]:
    """Values ``v`` of the folders ``key=v``."""
    return [n.split("=", 1)[1] for n in names(spark, path) if n.startswith(f"{key}=")]


def whole(spark: SparkSession, path: str) -> bool:
    """True once a Spark write into the folder has ended."""
    return exists(spark, f"{path}/_SUCCESS")


def remove_folder(spark: SparkSession, path: str) -> None:
    store, found = hadoop_path(spark, path)
    store.delete(found, True)
