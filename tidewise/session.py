"""Session builder: UTC, adaptive execution, ANSI off where the engine relies on null results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def build(master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults; anything the cluster sets wins if it is passed in `conf`."""
    builder = SparkSession.builder.appName("tidewise")
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for key, value in (defaults | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def cut_lineage(df: DataFrame) -> DataFrame:
    """df by way of a reliable checkpoint in the folder the cluster names (a local one only where none is set)."""
    spark = df.sparkSession
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or "/tmp/checkpoints")
    return df.checkpoint(eager=True)
