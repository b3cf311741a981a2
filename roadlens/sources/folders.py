"""Folders of a shared file system, through Hadoop's own client (any scheme Spark can write)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    sc = spark.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(sc._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    """Remove the folder or file ``path``, if it is there."""
    fs, where = _at(spark, path)
    fs.delete(where, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Move ``source`` to ``target``, which must not exist; its parent is made."""
    fs, old = _at(spark, source)
    new = _at(spark, target)[1]
    if fs.exists(new):
        raise FileExistsError(target)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"cannot move {source} to {target}")
