"""What exists below a path: Hadoop file listings, for local folders and remote stores alike."""

from __future__ import annotations

from pyspark.sql import SparkSession


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that match a glob pattern, in order; none when nothing does."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(status.getPath().toString() for status in found or [])
