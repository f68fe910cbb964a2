"""Names of folders and empty marker files, in whatever file system a path belongs to.

A marker says all it has to say by its name, so that making it is the one step that publishes something.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names in a folder; none if it does not exist."""
    files, where = _open(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(where)) if files.exists(where) else []


def mark(spark: SparkSession, path: str) -> None:
    """Make an empty file; it is an error if there is one of that name."""
    files, where = _open(spark, path)
    files.mkdirs(where.getParent())
    files.create(where, False).close()


def remove(spark: SparkSession, path: str) -> None:
    files, where = _open(spark, path)
    files.delete(where, True)
