"""Session settings the engine is made for, and frames kept for several uses."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.adaptive.coalescePartitions.enabled": "true", "spark.sql.execution.arrow.pyspark.enabled": "true", "spark.sql.session.timeZone": "UTC"}


def session(name: str = "umbra", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for k, v in (SETTINGS | settings).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def kept(df: DataFrame) -> DataFrame:
    """df computed once and kept in the folder of spark.checkpoint.dir, which all executors share, so that several uses
    and lost executors don't compute it again. Without that setting a local session gets a folder of its own."""
    spark = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="umbra-kept-"))
    return df.checkpoint(eager=True)
