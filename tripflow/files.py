"""The few file-system calls the package needs, on any Hadoop file system."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SPLIT_BYTES = 32 << 20  # of a table that is rewritten as it lies: a task sorts its split in memory
SPLIT = "spark.sql.files.maxPartitionBytes"


def at(spark: SparkSession, path: str):
    """The file system of a path, and the path, as Hadoop objects."""
    sc = spark.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(sc._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = at(spark, path)
    return bool(fs.exists(where))


def delete(spark: SparkSession, path: str) -> None:
    fs, where = at(spark, path)
    if fs.exists(where):
        fs.delete(where, True)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that match a glob, in order; none where nothing is there."""
    fs, where = at(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(where) or [])


@contextmanager
def small_splits(spark: SparkSession) -> Iterator[None]:
    """Files are scanned in splits of at most ``SPLIT_BYTES`` by the jobs inside."""
    before = spark.conf.get(SPLIT)
    spark.conf.set(SPLIT, f"{SPLIT_BYTES}b")
    try:
        yield
    finally:
        spark.conf.set(SPLIT, before)
