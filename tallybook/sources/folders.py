"""Small path operations through Hadoop, so they work on any shared storage."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    """False only when nothing is there; an access error raises."""
    fs, p = _resolve(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder, sorted; none when it does not exist."""
    fs, p = _resolve(spark, path)
    if not fs.exists(p):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(p))


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, listed in one call."""
    fs, p = _resolve(spark, pattern)
    return sorted(status.getPath().toString() for status in fs.globStatus(p) or [])


def touch(spark: SparkSession, path: str) -> None:
    fs, p = _resolve(spark, path)
    fs.create(p, True).close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder the library itself made; nothing happens if it is gone."""
    fs, p = _resolve(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _resolve(spark, source)
    if not fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"could not rename {source} to {target}")
