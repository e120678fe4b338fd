"""Session settings shared by jobs and tests."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "lapwise", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC timestamps.

    Leave ``master`` unset on a cluster. Keys in ``conf`` use ``__`` for ``.``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone: stored times without a zone mean UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Where tables that all executors must see are kept: the folder named in ``spark.checkpoint.dir``, else the warehouse."""
    named = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    return named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints"


def scratch(spark: SparkSession, name: str) -> str:
    """A folder of its own, not made yet, on shared storage."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` on shared storage, so it survives lost executors."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()
