"""Folders of shared storage, through the file system that Spark itself uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def delete_folder(spark: SparkSession, path: str) -> int:
    """Delete a folder with all it holds; 1 if it was there."""
    system, where = _file_system(spark, path)
    return int(system.delete(where, True))


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files under a folder; a listing, no file is opened."""
    system, where = _file_system(spark, path)
    return system.getContentSummary(where).getLength()
