"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_session(app_name: str = "marquee", **conf: str) -> SparkSession:
    """Session with the settings the operators are written for.

    Skewed join keys are split by adaptive execution, so it must stay on.
    Values passed by the caller (or by spark-submit) win.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Where a session names none, a temporary one is made for a local master; on a cluster
    that is an error, since executors would each write to a disk of their own.
    """
    sc = spark.sparkContext
    path = spark.conf.get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="marquee-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def landed(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back.

    Cuts the lineage: later plans start from files, so lost executors cost a re-read
    and not a re-run. Unlike a checkpoint the result is columnar, and later plans read
    only the columns they use.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
