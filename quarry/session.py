"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every quarry session wants; a cluster session built elsewhere keeps its own.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "quarry", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the quarry defaults.

    ``master`` and ``shuffle_partitions`` are only meant for local runs and tests;
    on a cluster leave them unset so the launcher's values apply.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only a local session without the setting
    (tests, single-machine runs) gets a fresh temporary folder; a cluster session
    without it is a configuration error, since a machine-local folder would be
    lost with its executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/object store) before running iterative or upsert jobs")
    local = tempfile.mkdtemp(prefix="quarry-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


# Paths handed out inside the ``scratch_space`` blocks that are open, innermost last.
_spaces: list[list[str]] = []


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A path below the shared checkpoint folder for written intermediate tables; whoever writes there makes it."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}"
    for space in _spaces[-1:]:
        space.append(path)
    return path


@contextmanager
def scratch_space(spark: SparkSession) -> Iterator[None]:
    """Remove the intermediate tables that the block's queries wrote once it ends.

    Query results are lazy, so write or collect what is wanted inside the block. Without such a block
    the tables stay in the checkpoint folder until that is cleaned up.
    """
    _spaces.append([])
    try:
        yield
    finally:
        for name in _spaces.pop():
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
