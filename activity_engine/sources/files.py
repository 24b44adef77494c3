"""Small file-system helpers that work on any Hadoop file system."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Observation, SparkSession


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; empty when it is absent."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(p))


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def observed(metrics: Observation, **empty: object) -> dict:
    """What was observed while a job ran. An input that is known to be empty beforehand is optimised away together
    with its metrics; then the given values count."""
    try:
        return {**empty, **metrics.get}
    except Py4JJavaError:
        return empty
