"""Session settings and the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """UTC time, and adaptive execution with skew splitting.

    Source times have no zone, so they are subtracted in a zone without daylight saving.

    Joins here carry no broadcast hint: the planner (and, with adaptive execution, the
    measured shuffle sizes) decides, so a side is broadcast only below
    ``spark.sql.autoBroadcastJoinThreshold``; anything larger is a sort-merge join whose hot
    partitions are split.  ``forceOptimizeSkewedJoin`` lets the split happen even when the
    next operator would have liked to reuse the join's partitioning.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


def build_session(app: str = "stayline", master: str | None = None, **conf: str) -> SparkSession:
    """A configured session; every size-dependent setting is left to the caller."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, else the warehouse's."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder; what stands there goes when the session ends."""
    path = f"{scratch_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def saved(df: DataFrame, label: str) -> DataFrame:
    """The same rows read back from a new table in the shared folder.

    For what is used more than once and is dear to compute, or to plan, again.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
